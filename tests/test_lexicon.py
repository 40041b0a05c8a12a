"""Vocabularies and phrases against brute force: hot words, overlapping hits, nothing at all."""

import random

import pytest

from cuelake.operators import lexicon

WORDS = "title_id string, pos bigint, words array<string>"


def cues(rng, n=120):
    pool = [f"w{k}" for k in range(40)]
    rows = [("t", k, ["de"] * rng.randrange(4) + [rng.choice(pool) for _ in range(rng.randrange(9))]) for k in range(n)]
    return [*rows, ("u", 1, []), ("u", 2, None), ("u", 3, ["w1", None, "w2"])]


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_known_words(spark, monkeypatch, rows):
    monkeypatch.setattr(lexicon, "BROADCAST_ROWS", rows)  # with and without the filter
    rng = random.Random(1)
    own = cues(rng)
    known = {"de", *(f"w{k}" for k in range(0, 40, 3)), "unused"}
    vocabulary = spark.createDataFrame([(w,) for w in [*known, "de", None]], "word string")
    got = {(r["title_id"], r["pos"]): r["words"] for r in lexicon.known_words(spark.createDataFrame(own, WORDS).repartition(3), vocabulary).collect()}
    assert got == {(t, p): [w for w in ws or [] if w in known] for t, p, ws in own}
    none = lexicon.known_words(spark.createDataFrame(own, WORDS), spark.createDataFrame([], "word string")).collect()
    assert len(none) == len(own) and not any(r["words"] for r in none)


def test_filter_keeps_all_known(spark):
    """No false negatives, and few false positives."""
    words = spark.createDataFrame([(f"k{k}",) for k in range(3000)], "word string")
    assert lexicon._may_be_known(words, words).count() == 3000
    assert lexicon._may_be_known(spark.createDataFrame([(f"x{k}",) for k in range(3000)], "word string"), words).count() < 300


def leftmost_longest(words, phrases):
    out, at = [], 0
    while at < len(words):
        n = max((len(p.split()) for p in phrases if words[at : at + len(p.split())] == p.split()), default=0)
        if n:
            out.append((at, n, " ".join(words[at : at + n])))
        at += max(n, 1)
    return out


def test_phrases(spark):
    rng = random.Random(2)
    own = [("t", k, [rng.choice("abc") for _ in range(rng.randrange(12))]) for k in range(150)]
    phrases = ["a b", "b c a", "a b c a", "c", "b b", "z", "c c c", ""]
    table = spark.createDataFrame([(p, kind) for p in phrases for kind in (("x", "y") if p == "c" else ("x",))] + [(None, "x")], "phrase string, kind string")
    got = sorted(tuple(r) for r in lexicon.phrase_hits(spark.createDataFrame(own, WORDS).repartition(2), table).collect())
    assert got == sorted((t, k, at, n, p, ["x", "y"] if p == "c" else ["x"]) for t, k, ws in own for at, n, p in leftmost_longest(ws, [p for p in phrases if p]))
    assert lexicon.phrase_hits(spark.createDataFrame(own, WORDS), spark.createDataFrame([], "phrase string, kind string")).count() == 0
    plan = lexicon.known_words(spark.createDataFrame(own, WORDS), table.selectExpr("phrase AS word"))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan
