"""Cues that arrive out of order, late and twice; streams that stop and go on."""

import random

import pytest
from pyspark.sql import functions as F

from cuelake.operators import merge
from cuelake.streaming import batches, merging

CUE = "title_id string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", merging.PROVIDER)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def titles(rng, n=6, each=40):
    rows = []
    for t in range(n):
        at = 0
        for p in range(1, each + 1):
            at += rng.choice([0, 50, 100, 400, 1500])
            length = rng.randrange(300, 2500)
            rows.append((f"t{t}", p, p, at, at + length, rng.choice(["", "", "", "[SC] ", "[NM] "]) + " ".join(rng.choice(["een", "twee...", "...drie", "vier."]) for _ in range(3))))
            at += length
    return rows


def arrive(spark, path, rows, minute):
    """A file of cues that came in within a minute."""
    if rows:
        spark.createDataFrame(rows, CUE).withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minute) + F.col("pos") % 60)).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out):
    stream = spark.readStream.schema(f"{CUE}, arrived timestamp").option("maxFilesPerTrigger", 2).parquet(path)
    query = merging.merge_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{out}-state").option("path", out).trigger(availableNow=True).start()
    query.awaitTermination(200)
    assert query.exception() is None


def rows_of(df):
    keys = ("title_id", "start_ms", "end_ms", "text", "source_count", "source_indices", "gap_ms")
    return sorted(repr([r[k] for k in keys]) for r in df.collect())


def test_shuffled_restarted_and_late(rocks, tmp_path):
    rng = random.Random(5)
    rows = titles(rng)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    mixed = list(rows)
    rng.shuffle(mixed)
    arrive(rocks, path, mixed[:60], 0)
    arrive(rocks, path, mixed[60:110], 1)
    run(rocks, path, out)
    arrive(rocks, path, mixed[110:], 2)  # after a stop: state comes from the checkpoint
    arrive(rocks, path, mixed[:5], 3)  # five cues come again
    run(rocks, path, out)
    before = rocks.read.parquet(out).where("not late").count()
    arrive(rocks, path, [("clock", 1, 1, 0, 1, "x")], 100)  # time goes on for all titles
    arrive(rocks, path, [("clock", 2, 2, 0, 1, "x")], 200)
    run(rocks, path, out)
    got = rocks.read.parquet(out).where("title_id <> 'clock'")
    want = merge.merge_cues(rocks.createDataFrame(rows, CUE))
    assert got.where("not late").count() > before
    assert rows_of(got.where("not late")) == rows_of(want)
    assert sorted((r["title_id"], r["first_pos"]) for r in got.where("late").collect()) == sorted(r[:2] for r in mixed[:5])


def test_missing_cues_are_given_up(rocks, tmp_path):
    """After the wait a hole is passed; what comes for it then is late, and told so."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    cue = [("t", p, p, 1000 * p, 1000 * p + 500, f"w{p}") for p in range(1, 8)]
    arrive(rocks, path, [c for c in cue if c[1] != 3][:5], 0)
    arrive(rocks, path, [("clock", 1, 1, 0, 1, "x")], 50)
    arrive(rocks, path, [("clock", 2, 2, 0, 1, "x")], 60)
    run(rocks, path, out)
    arrive(rocks, path, [cue[2], cue[6]], 61)
    arrive(rocks, path, [("clock", 3, 3, 0, 1, "x")], 150)
    run(rocks, path, out)
    got = rocks.read.parquet(out).where("title_id = 't'").collect()
    assert sorted(i for r in got for i in r["source_indices"]) == list(range(1, 8))
    assert [r["source_indices"] for r in got if r["late"]] == [[3]]


def test_batches_resume(spark, tmp_path):
    """Stopped in a step and between a batch's results and its entry in the log: rows equal one run."""
    rng = random.Random(6)
    rows = [(f"t{t}", p, p, 1000 * p, 1000 * p + rng.randrange(1100), rng.choice("abc")) for t in range(4) for p in range(1, 41)]
    path = str(tmp_path / "in")
    for k in range(4):
        spark.createDataFrame([r for r in rows if (r[1] - 1) // 10 == k], CUE).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(CUE).option("maxFilesPerTrigger", 1).parquet(path)
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    assert batches.run(stream, whole, batches.continuity) == 4
    seen = []

    def stops(cues):
        seen.append(cues.where("not is_context").agg(F.min("pos")).first()[0])
        if len(seen) == 2:  # in the second batch
            raise RuntimeError("stopped")
        return batches.continuity(cues)

    with pytest.raises(Exception, match="stopped"):
        batches.run(stream, broken, stops)
    assert batches.results(spark, broken).select("batch").distinct().count() == 1
    # results of the next batch are there in part, but it isn't in the log
    spark.createDataFrame([("t0", 11, 5, 5)], "title_id string, pos bigint, gap_ms bigint, repeats int").write.parquet(f"{broken}/results/batch=1")
    assert batches.results(spark, broken).count() == 40
    assert batches.run(stream, broken, stops) == 3 and seen == [1, 11, 11, 21, 31]
    assert batches.run(stream, broken, stops) == 0
    want = sorted(map(tuple, batches.results(spark, whole).drop("batch").collect()))
    assert sorted(map(tuple, batches.results(spark, broken).drop("batch").collect())) == want and len(want) == 160
    assert want == sorted(map(tuple, batches.continuity(spark.createDataFrame(rows, CUE).withColumn("is_context", F.lit(False))).collect()))
