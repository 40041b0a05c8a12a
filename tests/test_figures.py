"""Rounding at the edge, ranges on exact shares, order statistics by brute force."""

import random

import pytest
from pyspark.sql import functions as F

from cuelake.operators import orderstats, stats

RANGES = "genre string, lo int, hi int"


def test_tenths_and_ranges(spark):
    rows = [(2, 3), (1, 16), (3, 16), (1701, 2000), (17, 20), (1699, 2000), (7, 10), (699, 1000), (0, 5), (0, 0)]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(rows)], "k int, a bigint, b bigint").withColumn("permille", stats.permille(F.col("a"), F.col("b")))
    found = stats.in_genre_ranges(df, spark.createDataFrame([("documentary", 70, 85)], RANGES), "a", "b", "lo", "hi").orderBy("k").collect()
    assert [r["permille"] for r in found] == [667, 62, 188, 850, 850, 850, 700, 699, 0, None]  # 62.5 and 187.5, 850.5 and 849.5: halves to even
    assert [r["in_range"] for r in found[:9]] == [False, False, False, False, True, True, True, False, False]


def test_merge_ratio(spark):
    merged = spark.createDataFrame([("t", 2), ("t", 1)], "title_id string, source_count int")
    assert stats.merges(merged).first()["ratio_permille"] == 667


def test_trims_by_title(spark):
    rows = [("a", "trim", None, 400), ("a", "partial_trim", None, 101), ("a", "skip", "no_speech", 0), ("a", "skip", "short", 0), ("a", "skip", "no_speech", 0), ("b", "skip", "short", 0)]
    got = {r["title_id"]: r for r in stats.trim_titles(spark.createDataFrame(rows, "title_id string, action string, reason string, trim_ms bigint")).collect()}
    a, b = got["a"], got["b"]
    assert (a["total_cues"], a["full_trims"], a["partial_trims"], a["skipped"], a["total_trim_ms"], a["avg_trim_ms"], a["skip_reasons"]) == (5, 1, 1, 3, 501, 250, "no_speech: 2, short: 1")
    assert (b["total_cues"], b["avg_trim_ms"], b["skip_reasons"]) == (1, None, "short: 1")


def test_start_range_and_shares(spark):
    analyzed = spark.createDataFrame([("t", p, s, e) for p, s, e in ((1, -50, 5), (2, 150, None), (3, None, 7))], "title_id string, pos bigint, start_delta_ms bigint, end_delta_ms bigint")
    found = spark.createDataFrame([("t", 1, "low", "x")], "title_id string, pos bigint, severity string, type string")
    row = stats.timing_quality(analyzed, found).first()
    assert (row["start_delta_min"], row["start_delta_max"], row["start_delta_avg"]) == (-50, 150, 50)
    groups = spark.createDataFrame([("t", k) for k in ("1:1", "1:1", "2:1")], "title_id string, merge_type string")
    told = {r["name"]: r["percent"] for r in stats.pair_distribution(groups, spark.createDataFrame([("t", "expansion")], "title_id string, category string")).collect()}
    assert told == {"1:1": 67, "2:1": 33, "expansion": 33}


@pytest.mark.parametrize("ranges", [1024, 3])
def test_order_statistics(spark, monkeypatch, ranges):
    monkeypatch.setattr(orderstats, "RANGES", ranges)
    rng = random.Random(ranges)
    columns = [[5], [3, 3, 3, 3], [rng.randrange(-9, 9) for _ in range(200)], [rng.choice([-(2**61), 0, 7, 2**61, rng.randrange(2**60)]) for _ in range(501)]]
    for own in columns if ranges > 3 else columns[:3]:
        df = spark.createDataFrame([(v,) for v in [*own, None]], "v bigint").repartition(3)
        got = orderstats.select(df, "v", {"median": orderstats.upper_median, "p95": orderstats.share(95), "p1": orderstats.share(1)})
        s, n = sorted(own), len(own)
        assert got == {"n": n, "least": s[0], "greatest": s[-1], "total": sum(own), "median": s[n // 2], "p95": s[-(-95 * n // 100) - 1], "p1": s[max(1, -(-n // 100)) - 1]}
    none = orderstats.select(spark.createDataFrame([(None,)], "v bigint"), "v", {"median": orderstats.upper_median})
    assert none == {"n": 0, "least": None, "greatest": None, "total": None, "median": None}
