"""Operators on small titles."""

import json

from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.operators import asof, match, merge, pairs, rules, speech, stats, timing
from cuelake.plans import adapters
from cuelake.sources import srt
from cuelake.streaming import ingest

CUE = "title_id string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"


def cues(spark, rows, title="t"):
    return spark.createDataFrame([(title, i + 1, i + 1, a, b, x) for i, (a, b, x) in enumerate(rows)], CUE)


def merged(spark, rows, **options):
    return [(r["text"], r["start_ms"], r["end_ms"], r["source_count"]) for r in merge.merge_cues(cues(spark, rows), **options).orderBy("idx").collect()]


def test_merge_basics(spark):
    assert merged(spark, [(1000, 3000, "Eerste deel"), (3200, 5000, "tweede deel.")]) == [("Eerste deel tweede deel.", 1000, 5000, 2)]
    assert len(merged(spark, [(1000, 3000, "a"), (5000, 7000, "b")])) == 2
    assert len(merged(spark, [(0, 4000, "a"), (4200, 8000, "b")])) == 2
    assert merged(spark, [(1000, 2500, "Een"), (2700, 4000, "twee"), (4200, 5500, "drie.")]) == [("Een twee drie.", 1000, 5500, 3)]
    assert len(merged(spark, [(0, 1000, "a"), (1000, 2000, "b")])) == 1
    assert merged(spark, []) == []


def test_merge_markers(spark):
    assert [x[0] for x in merged(spark, [(0, 1000, "Eerste."), (1100, 2000, "[NM] Tweede.")])] == ["Eerste.", "Tweede."]
    assert [x[0] for x in merged(spark, [(0, 1000, "Waar ga je heen?"), (1100, 2000, "[SC] Naar huis.")])] == ["Waar ga je heen?\n-Naar huis."]
    assert [x[0] for x in merged(spark, [(0, 1000, "A"), (1100, 2000, "[SC] B"), (2100, 3000, "[SC] C")])] == ["A\n-B", "C"]
    assert len(merged(spark, [(0, 1000, "Vraag?\n-Antwoord."), (1100, 2000, "Meer.")])) == 2
    assert [x[0] for x in merged(spark, [(0, 1000, "Eerste deel..."), (1100, 2000, "...tweede deel.")])] == ["Eerste deel tweede deel."]


def test_merge_report(spark):
    row = merge.report(merge.merge_cues(cues(spark, [(1000, 3000, "a"), (3200, 5000, "b")]))).first()
    assert row["source_indices"] == [1, 2] and row["gap_ms"] == 200 and row["combined_duration_ms"] == 4000
    assert [tuple(x) for x in row["source_timecodes"]] == [(1000, 3000), (3200, 5000)]


def test_titles_are_apart(spark):
    both = cues(spark, [(0, 1000, "a")], "x").union(cues(spark, [(1100, 2000, "b")], "y"))
    assert merge.merge_cues(both).count() == 2


def codes(spark, rows):
    return sorted((r["idx"], r["code"]) for r in rules.violations(cues(spark, rows)).collect())


def test_rules(spark):
    assert codes(spark, [(0, 2000, "Eerste zin."), (2500, 4500, "Tweede zin."), (5000, 7000, "Derde zin.")]) == []
    assert (1, "cps_hard") in codes(spark, [(0, 1000, "A" * 60)]) and (1, "line_length") in codes(spark, [(0, 1000, "A" * 60)])
    assert codes(spark, [(0, 2000, ""), (3000, 5000, "   ")]) == [(1, "empty"), (2, "empty")]
    assert (2, "duplicate") in codes(spark, [(0, 2000, "Zelfde tekst."), (2500, 4500, "zelfde Tekst")])
    assert (2, "overlap") in codes(spark, [(0, 5000, "Een langere zin."), (4000, 7000, "Nog een zin.")])
    assert (2, "ellipsis_open") in codes(spark, [(0, 2000, "Eerste..."), (2500, 4500, "tweede deel")])
    assert (2, "ellipsis_lone") in codes(spark, [(0, 2000, "Eerste."), (2500, 4500, "...tweede deel")])
    assert (1, "first_dash") in codes(spark, [(0, 4000, "-Een zinnetje\n-Twee zinnen")])
    assert (2, "order") in codes(spark, [(5000, 7000, "Eerste zin."), (4000, 4900, "Tweede zin.")])


def test_sequence_told_once(spark):
    df = cues(spark, [(i * 3000, i * 3000 + 2000, f"Zin nummer {i}.") for i in range(5)]).withColumn("idx", F.when(F.col("pos") > 2, F.col("idx") + 4).otherwise(F.col("idx")))
    assert rules.violations(df).where("code = 'sequence'").count() == 1


def test_overlap(spark):
    row = timing.fix_overlap(cues(spark, [(1000, 5000, "a"), (4500, 6000, "b")])).orderBy("pos").first()
    assert row["new_end_ms"] == 4380 and row["fixed_by"] == 2
    row = timing.fix_overlap(cues(spark, [(1000, 5000, "a"), (1050, 6000, "b")])).orderBy("pos").first()
    assert row["new_end_ms"] == 5000 and row["unfixable"]


def test_fix_srt_settles(spark):
    once = timing.fix_srt(cues(spark, [(0, 2000, "Stop!"), (1900, 4000, "Tekst…"), (5000, 6000, ""), (7000, 9000, "- A\n- B")]))
    assert [(r["text"], r["idx"]) for r in once.orderBy("pos").collect()] == [("Stop.", 1), ("Tekst...", 2), ("A\n-B", 3)]
    twice = timing.fix_srt(once.select("title_id", "pos", "idx", "start_ms", "end_ms", "text"))
    assert twice.select("idx", "start_ms", "end_ms", "text").orderBy("idx").collect() == once.select("idx", "start_ms", "end_ms", "text").orderBy("idx").collect()


def trim(spark, rows, ends, **options):
    spoken = spark.createDataFrame([("t", e) for e in ends], "title_id string, end_ms bigint")
    row = speech.trim(cues(spark, rows), spoken, min_duration=830, **options).orderBy("pos").first()
    return row["action"], row["reason"] or row["new_end_ms"]


def test_trim(spark):
    assert trim(spark, [(1000, 3000, "Tekst.")], [2200]) == ("trim", 2450)
    assert trim(spark, [(0, 3000, "Tekst.")], [1500]) == ("trim", 1750)
    assert trim(spark, [(1000, 2000, "x")], [2500]) == ("skip", "speech_extends_past_cue")
    assert trim(spark, [(1000, 2000, "x")], []) == ("skip", "no_transition")
    assert trim(spark, [(1000, 2550, "x")], [2300]) == ("skip", "below_min_trim")
    assert trim(spark, [(1000, 2100, "x")], [1900], min_trim=100) == ("skip", "buffer_exceeds_current_end")
    assert trim(spark, [(1000, 3000, "x")], [1100]) == ("skip", "min_duration")
    assert trim(spark, [(1000, 3000, "x"), (2300, 4000, "y")], [2000]) == ("trim", 2180)
    assert trim(spark, [(5000, 8000, "x")], [6000, 7200, 9000]) == ("trim", 7450)
    action, end = trim(spark, [(0, 6000, "a" * 90)], [4500])
    assert action == "partial_trim" and 90 * 1000 <= 17 * end + 17


def test_extension_and_credit(spark):
    out = timing.extend_cps(cues(spark, [(0, 1000, "a" * 25), (5000, 6000, "b" * 25)])).orderBy("pos").collect()
    assert [r["end_ms"] for r in out] == [2000, 7000]
    assert [r["end_ms"] for r in timing.close_gaps(cues(spark, [(0, 1000, "a"), (1500, 2000, "b")])).orderBy("pos").collect()] == [1380, 2000]
    added = timing.add_credit(cues(spark, [(0, 1000, "a")]), "Door mij")
    assert added.count() == 2 and timing.add_credit(added, "Door mij").count() == 2


def test_nearest_ties_and_range(spark):
    left, right = spark.createDataFrame([("t", 100), ("t", 500), ("u", 1)], "title_id string, at bigint"), spark.createDataFrame([("t", 90), ("t", 110), ("t", 110)], "title_id string, m bigint")
    out = {(r["title_id"], r["at"]): (r["nearest_ms"], r["distance_ms"]) for r in asof.nearest(left, right, "at", "m", within=50).collect()}
    assert out == {("t", 100): (90, 10), ("t", 500): (None, None), ("u", 1): (None, None)}


def test_overlapping_pairs_once(spark):
    a, b = cues(spark, [(0, 60000, "a"), (70000, 71000, "b")]), cues(spark, [(5000, 45000, "x"), (60000, 70000, "y")])
    assert asof.overlapping(a, b).select("pos", "p_pos").collect() == [(1, 1)]


def en_cues(spark, n=20, step=2500, length=2000):
    return cues(spark, [(i * step, i * step + length, f"en {i}") for i in range(n)])


def test_matching(spark):
    nl = cues(spark, [(1000, 3000, "nl")])
    assert match.match_proximity(nl, cues(spark, [(1300, 2000, "x")])).count() == 1
    assert match.match_proximity(nl, cues(spark, [(5000, 6000, "x")])).count() == 0
    row = match.draft_mapping(cues(spark, [(0, 1000, "nl")]), cues(spark, [(800, 1500, "en")])).first()
    assert row["en_indices"] == [1] and row["en_end_ms"] == 1500


def enhanced(spark, start):
    merges = spark.createDataFrame([("t", 0, 12500, [(12500, 14500), (15000, 17000)])], "title_id string, entry_no int, output_start_ms bigint, source_timecodes array<struct<start_ms: bigint, end_ms: bigint>>")
    drafts = spark.createDataFrame([], "title_id string, entry_no int, nl_start_ms bigint, en_start_ms bigint, en_end_ms bigint")
    return sorted((r["en_pos"] - 1, r["strategy"]) for r in match.match_enhanced(cues(spark, [(start, 17000, "nl")]), en_cues(spark), merges, drafts).collect())


def test_merge_map_precedence(spark):
    assert enhanced(spark, 12500) == [(5, "merge"), (6, "merge"), (7, "merge")]  # 17500 is just within reach
    assert enhanced(spark, 12530)[0][1] == "merge"
    assert enhanced(spark, 12600)[0][1] == "proximity"


def test_speech(spark):
    bits = [0, 0, 1, 1, 0, 0, 1, 0, 0, 0, 1, 0]
    frames = spark.createDataFrame([("t", i, bool(b)) for i, b in enumerate(bits)], "title_id string, frame_idx bigint, is_speech boolean")
    assert [(r["first_frame"], r["end_frame"]) for r in speech.smooth(frames, 2).where("is_speech").orderBy("first_frame").collect()] == [(2, 7), (10, 11)]
    assert [(r["start_ms"], r["end_ms"]) for r in speech.segments(speech.smooth(frames, 7)).collect()] == [(60, 330)]


def test_pairs(spark):
    en, nl = cues(spark, [(0, 1000, "one two"), (1000, 2000, "three four"), (5000, 6000, "alone")]), cues(spark, [(0, 2000, "een twee drie"), (9000, 9500, "extra")])
    rows = {r["group_key"]: r for r in pairs.align(en, nl).collect()}
    assert rows["g1"]["merge_type"] == "2:1 merge" and rows["e3"]["merge_type"] == "1:0 remap" and rows["n2"]["merge_type"] == "0:1 remap"
    assert "merge" in {r["category"] for r in pairs.categories(pairs.align(en, nl)).collect()}


def test_drift(spark):
    near = asof.nearest(cues(spark, [(10000 * i + (6000 if 2 <= i <= 4 else 0), 0, "") for i in range(8)]).select("title_id", "pos", "idx", "start_ms"), cues(spark, [(10000 * i, 0, "") for i in range(3)] + [(80000, 0, "")]), "start_ms", "start_ms")
    assert rules.drift_runs(near).where("severity = 'error'").count() == 1


def test_srt_round_trip(spark, tmp_path):
    rows = [(0, 1000, "Één\n-Twee"), (1500, 2000, "123")]
    content = srt.render(cues(spark, rows))
    assert content.first()["content"].startswith("﻿1\r\n00:00:00,000 --> 00:00:01,000\r\n")
    assert [(r["start_ms"], r["end_ms"], r["text"]) for r in srt.parse(content).orderBy("pos").collect()] == rows
    (tmp_path / "a.nl.srt").write_bytes("1\n00:00:00.000 --> 00:00:01.000\ncafé\n\nx\n00:00:00,000 --> 00:00:01,000\ny\n\n3\nbad\nz\n\n4".encode("cp1252"))
    files = srt.read_files(spark, str(tmp_path), windows=True)
    assert [(r["title_id"], r["text"]) for r in srt.parse(files).collect()] == [("a", "café")]
    assert [r["reason"] for r in srt.parse_errors(files).orderBy("block_no").collect()] == ["Invalid index", "Invalid timecode", "Insufficient lines"]
    assert srt.parse(srt.read_files(spark, str(tmp_path))).first()["text"] == "café"


def test_reports(spark, tmp_path):
    path = tmp_path / "film.json"
    path.write_text(json.dumps({"mappings": [{"nl_start_ms": 1, "nl_end_ms": 2, "en_indices": [3], "en_start_ms": None, "en_end_ms": None}]}))
    row = srt.read_report(spark, str(path), "mappings").first()
    assert row["title_id"] == "film" and row["en_indices"] == [3] and row["en_start_ms"] is None
    assert srt.read_report(spark, str(tmp_path / "none.json"), "merges").count() == 0
    for text in ("[1, 2]", '{"unfixable_cue_indices": [1, 2]}', "1\n2\n"):
        path.write_text(text)
        assert sorted(r[0] for r in srt.read_index_list(spark, str(path)).collect()) == [1, 2]


def test_tasks_grow_with_the_table(spark, tmp_path):
    assert [adapters.tasks(n, 8) for n in (0, 1, 536, 5012, 125_300, 1_500_000)] == [1, 1, 6, 8, 63, 750]
    spark.createDataFrame([(k, 1, "a", "een twee") for k in range(12_001)], "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    en = adapters.en_cues(spark, str(tmp_path))
    # titles are dealt once: a table of cues and what is set against it keep to the same tasks
    assert en.rdd.getNumPartitions() == match.title_cards(en, en).rdd.getNumPartitions() == 7 and en.count() == 12_001


def test_runs_of_frames_across_words(spark):
    values = [True] * 70 + [False] * 3 + [None, None] + [False] + [True] * 130 + [False] * 60
    rows = [("t", k, v) for k, v in enumerate(values)] + [("t", 500, False), ("t", 620, True), ("u", 59, True), ("u", 60, True), ("u", 61, False), ("u", -1, True)]
    frames = spark.createDataFrame(rows, "title_id string, frame_idx bigint, is_speech boolean")
    found = speech.runs(frames)
    got = [tuple(r)[2:] for r in found.where("title_id = 't'").orderBy("run_no").collect()]
    assert got == [(True, 0, 70), (False, 70, 73), (None, 73, 74), (None, 74, 75), (False, 75, 76), (True, 76, 206), (False, 206, 501), (True, 620, 621)]
    assert [tuple(r)[2:] for r in found.where("title_id = 'u'").orderBy("run_no").collect()] == [(True, -1, 61), (False, 61, 62)]
    # frames are not sorted, what they make is
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("bit_or")


def test_rebalanced_works_its_text_out_once(spark):
    own = cues(spark, [(0, 9000, "Dit is de\nzaak van de eeuw in het Rode Kruis zegt hij"), (9500, 9900, "Een regel")]).withColumn("text", T.collapse(F.concat("text", F.lit("  "))))
    own = own.withColumn("text", F.regexp_replace("text", "de zaak", "de\nzaak"))
    found = stats.rebalanced(own).where("outcome = 'fixed'")
    # a filter on the outcome is not pushed down through what the outcome is made of
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") < 40
    assert [r["text"] for r in found.collect()] == ["Dit is de zaak van de eeuw\nin het Rode Kruis zegt hij"]
    assert stats.rebalance(own)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") < 40


def test_rebalance_and_stats(spark):
    out = stats.rebalance(cues(spark, [(0, 2000, "Kort en\nklein")])).first()
    assert out["outcome"] == "unbroken" and out["text"] == "Kort en klein"
    row = stats.validation(cues(spark, [(0, 1000, "a" * 30), (2000, 2000, "b")])).first()
    assert row["cps_above_hard"] == 1 and row["total_cues"] == 2


def test_stream_is_the_batch(spark, tmp_path):
    """Sessions that the watermark closes come out of the stream as the batch has them."""
    import datetime

    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=m), u, "x", 0.0, "") for i, (u, m) in enumerate([(1, 0), (1, 10), (1, 50), (2, 5), (2, 34), (2, 70), (1, 60)])]
    later = [(100, start + datetime.timedelta(days=1), 3, "x", 0.0, "")]
    folder = str(tmp_path / "e")
    spark.createDataFrame(rows, ingest.EVENTS).coalesce(1).write.parquet(folder)
    spark.createDataFrame(later, ingest.EVENTS).coalesce(1).write.mode("append").parquet(folder)
    asked = ingest.sessions(ingest.read(spark, folder)).writeStream.outputMode("append").format("memory").queryName("closed").option("checkpointLocation", str(tmp_path / "c")).start()
    asked.processAllAvailable()
    asked.stop()
    want = sorted(map(tuple, ingest.sessions(spark.read.parquet(folder)).where("user_id <> 3").collect()))
    assert sorted(map(tuple, spark.table("closed").collect())) == want and len(want) == 4


def test_valid_counts_everything(spark):
    own = cues(spark, [(0, 2000, "Eerste zin."), (2500, 4500, "Tweede zin.")])
    none = rules.violations(own)
    drift = spark.createDataFrame([("t", "warning"), ("t", "error")], "title_id string, severity string")
    unread = spark.createDataFrame([("t", 1, "Invalid index", "x")], "title_id string, block_no int, reason string, raw string")
    assert tuple(stats.summary(own, none).first())[1:] == (2, 0, 0, True)
    assert tuple(stats.summary(own, none, drift).first())[1:] == (2, 1, 1, False)
    assert tuple(stats.summary(own, none, parse_errors=unread).first())[1:] == (2, 1, 0, False)


def test_files_of_two_languages(spark, tmp_path):
    block = "1\n00:00:00,000 --> 00:00:01,000\n{}\n"
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    for name, text in (("a/film.en.srt", "one"), ("a/film.nl.srt", "een"), ("b/film.nl.srt", "twee"), ("b/film.srt", "drie")):
        (tmp_path / name).write_text(block.format(text) * 1 + "\n".join(["", "2", "00:00:02,000 --> 00:00:03,000", *["line"] * 1200]))
    rows = srt.parse(srt.read_files(spark, str(tmp_path / "*"))).collect()
    assert sorted((r["folder"][-1], r["title_id"], r["lang"] or "", r["text"]) for r in rows if r["pos"] == 1) == [("a", "film", "en", "one"), ("a", "film", "nl", "een"), ("b", "film", "", "drie"), ("b", "film", "nl", "twee")]
    assert all(len(r["text"].split("\n")) == 1200 for r in rows if r["pos"] == 2)


def test_windows_characters(spark):
    raw = [bytes(range(0xA0, 0x100)), "€‘’“”…–— œŸ".encode("cp1252"), b"caf\xe9 \x81", "één".encode(), b"", None]
    want = [raw[0].decode("cp1252"), raw[1].decode("cp1252"), raw[2].decode("latin-1"), "één", "", None]
    df = spark.createDataFrame(list(enumerate(raw)), "n int, c binary")
    assert [r[0] for r in df.orderBy("n").select(srt.decoded_windows(F.col("c"))).collect()] == want


def test_reports_come_back(spark, tmp_path):
    merged_cues = merge.merge_cues(cues(spark, [(1000, 3000, "a"), (3200, 5000, "b"), (9000, 9500, "c"), (9600, 9900, "d")], "film één").union(cues(spark, [(0, 900, "x"), (1000, 2000, "y")], "u")))
    told = merge.report(merged_cues)
    srt.write_report(told, str(tmp_path / "m"), "merges")
    back = srt.read_report(spark, str(tmp_path / "m"), "merges").drop("entry_no")
    assert sorted(map(repr, back.select(*told.columns).collect())) == sorted(map(repr, told.collect())) and told.count() == 3
    drafts = match.draft_mapping(cues(spark, [(0, 1000, "nl"), (9000, 9500, "x")]), cues(spark, [(800, 1500, "en")]))
    srt.write_report(drafts, str(tmp_path / "d"), "mappings")
    assert srt.read_report(spark, str(tmp_path / "d"), "mappings").count() == 2
    assert tuple(stats.mappings(drafts, cues(spark, [(800, 1500, "en")])).first()) == ("t", 2, 1, 1, 1)
    with_told = merge.with_report(merged_cues.where("title_id = 'u'"), told).collect()
    assert len(with_told) == 1


def test_files_are_not_overwritten(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    own = cues(spark, [(0, 1000, "a\nb"), (1500, 2000, "c")])
    srt.write_files(own, str(tmp_path / "out"))
    written = [p.read_bytes() for p in (tmp_path / "out").glob("title_id=t/*.txt")]
    assert len(written) == 1 and b"\r\na\r\nb\r\n" in written[0]
    with pytest.raises(AnalysisException):
        srt.write_files(own, str(tmp_path / "out"))


def test_components_of_islands(spark):
    import random

    rng = random.Random(9)
    rows = sorted({(t, e, max(1, e + rng.randrange(-2, 3))) for t in "abc" for e in range(1, 60) for _ in range(rng.randrange(0, 3))})
    got = {(r["title_id"], r["side"], r["pos"]): r["root"] for r in pairs._components(spark.createDataFrame(rows, "title_id string, en_pos bigint, nl_pos bigint")).collect()}
    label = {x: x for t, e, n in rows for x in ((t, 0, e), (t, 1, n))}
    for _ in range(200):
        for t, e, n in rows:
            label[t, 0, e] = label[t, 1, n] = min(label[t, 0, e], label[t, 1, n])
    assert got == {x: least[2] for x, least in label.items()}


def test_alignment_outcomes(spark):
    own = cues(spark, [(2000, 4000, "een twee drie vier"), (5000, 6000, "een"), (7000, 8000, "een twee"), (9000, 9900, "een twee drie vier"), (12000, 13000, "een twee")])
    said = [(1, k, 60 + 20 * k, 75 + 20 * k) for k in range(1, 5)] + [(4, 1, 10, 20), (5, 1, 700, 710), (5, 2, 720, 730)]
    segments = spark.createDataFrame([("t", *s) for s in said], "title_id string, idx int, word_no int, start_frame int, end_frame int")
    out = timing.alignment_outcomes(segments, own)
    assert [r["outcome"] for r in out.orderBy("idx").collect()] == ["aligned", "skipped_short", "skipped_short", "skipped_confidence", "skipped_short"]
    row = stats.alignment(out).first()
    assert (row["total_cues"], row["aligned"], row["skipped_short"], row["skipped_confidence"], row["significant"]) == (5, 1, 3, 1, 1)
    assert timing.significant_corrections(segments, own).count() == 1


def test_groups_of_any_overlaps(spark, monkeypatch):
    import random

    monkeypatch.setattr(pairs, "PAIRS", 7)
    rng = random.Random(5)
    own = []
    for t in (*"abcd", None):
        for _ in range(2):
            at = sorted(rng.randrange(0, 20000) for _ in range(30))
            own.append([(t, k, k, s, None if k == 9 else s + rng.choice([0, 5, 300, 900, 900, 6000 if t == "a" else 900]), f"{t} {k}") for k, s in enumerate(at, 1)])
    schema = "title_id string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"
    sides = [[r for rows in own[side::2] for r in rows] for side in (0, 1)]
    got = {(r["title_id"], r["group_key"]): (r["en_count"], r["nl_count"], r["en_text"], r["nl_text"], r["at_ms"], r["span_ms"]) for r in pairs.align(*(spark.createDataFrame(rows, schema) for rows in sides)).collect()}
    cue = {(r[0], side, r[1]): r for side in (0, 1) for r in sides[side]}
    label = {x: (x[1], x[2]) for x in cue}
    edges = []
    for x, a in cue.items():
        for y, b in cue.items():
            if x[0] is not None and x[0] == y[0] and x[1] < y[1] and a[4] is not None and b[4] is not None:
                shared = min(a[4], b[4]) - max(a[3], b[3])
                if shared > 0 and shared * 100 >= 10 * max(1, min(a[4] - a[3], b[4] - b[3])):
                    edges.append((x, y))
    for _ in range(70):
        for x, y in edges:
            label[x] = label[y] = min(label[x], label[y])
    groups = {}
    for x in cue:
        groups.setdefault((x[0], label[x]), []).append(x)
    expected = {}
    for (t, (side, pos)), members in groups.items():
        e, n = (sorted((cue[x] for x in members if x[1] == k), key=lambda r: (r[3], r[1])) for k in (0, 1))
        ends = [r[4] for r in e + n if r[4] is not None]
        span = max(ends) - min(r[3] for r in e + n) if ends else None
        key = f"{'g' if e and n else 'en'[side]}{pos}"
        expected[t, key] = (len(e), len(n), " ".join(r[5] for r in e), " ".join(r[5] for r in n), (e or n)[0][3], span)
    assert got == expected and max(v[0] for v in got.values()) > 5


def test_alignment_deals_titles_once(spark):
    """Both versions dealt alike: no join, no group in Python, no further shuffle."""
    rows = [(1000 * k, 1000 * k + 900, "x") for k in range(9)]
    en, nl = (cues(spark, rows).repartition(3, "title_id") for _ in range(2))
    plan = pairs.align(en, nl)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FlatMapGroups" not in plan and plan.count("Exchange") == 2


def test_kinds_take_one_pass(spark):
    en, nl = cues(spark, [(0, 1000, "one two"), (1000, 2000, "three four"), (5000, 6000, "alone at last")]), cues(spark, [(0, 2000, "een twee drie"), (5000, 5900, "nu...")])
    groups = pairs.align(en, nl)
    found = stats.kind_shares(pairs.kinds(groups))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    told = [sorted(map(tuple, df.collect())) for df in (found, stats.pair_distribution(groups, pairs.categories(groups)))]
    assert told[0] == told[1] and ("t", "mapping", "2:1 merge", 1, 50, 2) in told[0]


def test_exemplars_are_dealt_by_category_only(spark):
    own = pairs.categories(pairs.align(cues(spark, [(0, 900, "one two three")]), cues(spark, [(0, 900, "- Ja?\n- Nee...")])))
    found = pairs.exemplars(own, 5)
    assert "hashpartitioning(title_id#" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "group_key" not in "".join(x for x in plan.split("\n") if "hashpartitioning" in x)
    assert {r["category"] for r in found.collect()} == {"dual-speaker", "idiom-candidate", "continuation"}  # short, but with two speakers
