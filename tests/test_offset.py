"""Offsets of titles from speech: planted ones are found, and the curve is the brute-force overlap at every millisecond."""

import random

from cuelake.operators import offset

CUE, SPEECH = "title_id string, pos bigint, idx int, start_ms bigint, end_ms bigint, text string", "title_id string, seg_no bigint, start_ms bigint, end_ms bigint"


def made(rng, title, n, off, jitter):
    cues, speech, at = [], [], rng.randrange(30_000)
    for k in range(n):
        length = rng.randrange(700, 4000)
        speech.append((title, k + 1, at, at + length))
        start = at - off + rng.randrange(-jitter, jitter + 1)
        cues.append((title, k + 1, k + 1, start, start + length + rng.randrange(0, 400), "x"))
        at += length + rng.randrange(100, 5000)
    return cues, speech


def overlap(cues, speech, off):
    return sum(max(0, min(c[4] + off, s[3]) - max(c[3] + off, s[2])) for c in cues for s in speech)


def test_planted_offsets(spark):
    rng, planted, cues, speech = random.Random(3), {}, [], []
    for k in range(12):
        planted[f"t{k}"] = off = rng.choice([0, -52_345, 41_007, 1234, -300, rng.randrange(-55_000, 55_000)])
        c, s = made(rng, f"t{k}", rng.choice([30, 80]), off, 60)
        cues += c
        speech += s
    cues += [("silent", 1, 1, 0, 1000, "x"), ("far", 1, 1, 0, 1000, "x")]
    speech += [("far", 1, 10**7, 10**7 + 500), ("unheard", 1, 0, 10)]
    own, spoken = spark.createDataFrame(cues, CUE).repartition(3), spark.createDataFrame(speech, SPEECH)
    got = {r["title_id"]: r for r in offset.offsets(own, spoken).collect()}
    assert set(got) == set(planted)
    for title, off in planted.items():
        assert abs(got[title]["offset_ms"] - off) < 250 and got[title]["score"] > 700
        c, s = [x for x in cues if x[0] == title], [x for x in speech if x[0] == title]
        assert got[title]["overlap_ms"] == overlap(c, s, got[title]["offset_ms"])
        near = range(got[title]["offset_ms"] - 150, got[title]["offset_ms"] + 151, 3)
        assert max(overlap(c, s, o) for o in near) == got[title]["overlap_ms"]
    moved = offset.apply(own, offset.offsets(own, spoken), 500).where("title_id in ('silent', 'far', 't0')").collect()
    assert {r["offset_ms"] for r in moved if r["title_id"] != "t0"} == {0} and len(moved) == 2 + sum(c[0] == "t0" for c in cues)


def test_nothing(spark):
    none = spark.createDataFrame([], CUE)
    assert offset.offsets(none, spark.createDataFrame([], SPEECH)).count() == 0
