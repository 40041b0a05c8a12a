"""The .srt data source: names, bytes, refusals, failed tasks, and what the parser of contents says of the same files."""

import os

import pytest
from pyspark.sql import functions as F

from cuelake.sources import files, srt

CUE = "title_id string, lang string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"
ROWS = [
    ("film", "nl", 1, 1, 0, 1500, "Een\ntwee"), ("film", "nl", 2, 7, 2000, 3_723_004, ""), ("film", "en", 1, 1, -5, 900, "One – é 🙂"),
    ("Film.2 (1999)", None, 1, None, 10, 20, "x"), ("film", "pt-br", 1, 1, 1, 2, "Olá"), ("film", "eng", 1, 1, 1, 2, None),
]


@pytest.fixture(scope="module")
def source(spark):
    spark.dataSource.register(files.SrtFiles)
    return spark


def cues(spark, rows):
    return spark.createDataFrame(rows, CUE)


def save(df, path, mode="append", **options):
    files.in_files(df).write.format("srt").mode(mode).options(**options).save(str(path))


def test_names_and_bytes(source, tmp_path):
    out = tmp_path / "out"
    save(cues(source, ROWS).repartition(5), out)
    assert sorted(os.listdir(out)) == ["Film.2 (1999).srt", "film.en.srt", "film.eng.srt", "film.nl.srt", "film.pt-br.srt"]
    assert (out / "film.nl.srt").read_bytes() == "﻿1\r\n00:00:00,000 --> 00:00:01,500\r\nEen\r\ntwee\r\n\r\n7\r\n00:00:02,000 --> 01:02:03,004\r\n\r\n".encode()
    for r in srt.render(cues(source, ROWS).where("title_id = 'film' and lang = 'nl'")).collect():
        assert r["content"].encode() == (out / "film.nl.srt").read_bytes()
    back = {tuple(r) for r in source.read.format("srt").load(str(out)).collect()}
    assert back == {("film", "nl", 1, 1, 0, 1500, "Een\ntwee"), ("film", "nl", 2, 7, 2000, 3_723_004, ""), ("film", "en", 1, 1, 0, 900, "One – é 🙂"), ("film", "pt-br", 1, 1, 1, 2, "Olá"), ("film", "eng", 1, 1, 1, 2, "")}
    errors = source.read.format("srt").option("errors", "true").load(str(out)).collect()
    assert [(r["title_id"], r["reason"]) for r in errors] == [("Film.2 (1999)", "Invalid index")]  # it was written without a number
    assert {r["lang"] for r in source.read.format("srt").option("lang", "nl").load(str(out)).collect()} == {"nl"}


def test_no_overwriting(source, tmp_path):
    out = tmp_path / "out"
    save(cues(source, ROWS[:2]), out)
    before = (out / "film.nl.srt").read_bytes()
    changed = [(*ROWS[0][:-1], "Anders"), ROWS[2]]
    with pytest.raises(Exception, match="exist already, among them film.nl.srt"):
        save(cues(source, changed), out)
    assert os.listdir(out) == ["film.nl.srt"] and (out / "film.nl.srt").read_bytes() == before
    save(cues(source, changed), out, mode="overwrite")
    assert sorted(os.listdir(out)) == ["film.en.srt", "film.nl.srt"] and b"Anders" in (out / "film.nl.srt").read_bytes()
    save(cues(source, [("other", "nl", 1, 1, 0, 1, "x")]), out)
    assert len(os.listdir(out)) == 3


def test_failed_task_leaves_nothing(source, tmp_path):
    """Titles written before the failure, and the one that it cuts off, don't appear."""
    out = tmp_path / "out"
    many = [(f"t{k}", "nl", p, p, 0, 1, "x" * 1000) for k in range(20) for p in range(1, 30)]
    bad = cues(source, many).withColumn("text", F.when((F.col("title_id") == "t7") & (F.col("pos") == 25), F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        save(bad, out)
    assert not [f for _, _, names in os.walk(out) for f in names]
    assert not os.path.isdir(out) or os.listdir(out) == []
    save(cues(source, many), out)
    assert len(os.listdir(out)) == 20 and source.read.format("srt").load(str(out)).count() == len(many)


def test_scattered_and_unordered_rows(source, tmp_path):
    rows = [("a", "nl", p, p, p, p + 1, "x") for p in range(1, 9)]
    with pytest.raises(Exception, match="several tasks"):
        cues(source, rows).repartition(4).sortWithinPartitions("pos").write.format("srt").mode("append").save(str(tmp_path / "a"))
    with pytest.raises(Exception, match="out of order"):
        cues(source, rows).coalesce(1).sortWithinPartitions(F.desc("pos")).write.format("srt").mode("append").save(str(tmp_path / "b"))
    with pytest.raises(Exception, match="don't come together"):
        cues(source, [rows[0], ("b", "nl", 1, 1, 1, 2, "x"), rows[1]]).coalesce(1).write.format("srt").mode("append").save(str(tmp_path / "c"))
    with pytest.raises(Exception, match="no file can be named"):
        save(cues(source, [("a/b", "nl", 1, 1, 1, 2, "x")]), tmp_path / "d")
    assert not [f for _, _, names in os.walk(tmp_path) for f in names]


def test_agrees_with_the_parser_of_contents(source, tmp_path):
    odd = "﻿\r\n\r\n1\r\n00:00:00.000 --> 00:00:01.000\rcafé\n\n\n\nx\n00:00:00,000 --> 00:00:01,000\ny\n\n 3 \nbad\nz\n\n4\n\n5\n 1:00:00,000  -->  01:00:00,500 X1:1\n a \n\n99999999999\n00:00:00,000 --> 00:00:01,000\nb\n\n+6\n00:00:00,000 --> 00:00:01,000"
    (tmp_path / "sub").mkdir()
    for name, raw in (("a.nl.srt", odd.encode()), ("b.srt", odd.replace("﻿", "").encode("cp1252")), ("sub/c.en.srt", b""), ("sub/d.en.srt", odd.replace("é", "\x93").replace("﻿", "").encode("latin-1")), ("sub/e.txt", b"1")):
        (tmp_path / name).write_bytes(raw)
    for windows in (False, True):
        contents = srt.read_files(source, [str(tmp_path), str(tmp_path / "sub")], windows=windows)
        load = source.read.format("srt").option("windows", str(windows).lower()).option("partitionBytes", "100")
        keys = ["title_id", "lang", "pos", "idx", "start_ms", "end_ms", "text"]
        assert sorted(map(repr, srt.parse(contents).select(*keys).collect())) == sorted(map(repr, load.load(str(tmp_path)).collect()))
        assert load.load(str(tmp_path)).rdd.getNumPartitions() == 4
        keys = ["title_id", "lang", "block_no", "reason", "raw"]
        assert sorted(map(repr, srt.parse_errors(contents).select(*keys).collect())) == sorted(map(repr, load.option("errors", "true").load(str(tmp_path)).collect()))


def test_empty_and_title_cards(source, tmp_path):
    save(cues(source, []), tmp_path / "none")
    (tmp_path / "empty").mkdir()
    assert source.read.format("srt").load(str(tmp_path / "empty")).count() == 0
    cards = cues(source, [("film", None, 1, 9, 5000, 6000, "LATER"), ("film", None, 2, 4, 1000, 2000, "PARIS")]).drop("lang")
    save(files.title_card_files(cards), tmp_path / "cards")
    assert os.listdir(tmp_path / "cards") == ["film.title_cards.srt"]
    assert [(r["idx"], r["text"]) for r in source.read.format("srt").load(str(tmp_path / "cards")).orderBy("pos").collect()] == [(1, "PARIS"), (2, "LATER")]
