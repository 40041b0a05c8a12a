"""Recall of nearest neighbours where residuals don't point in random directions, and the exact way."""

import numpy as np
import pytest

from cuelake.llm import fingerprints, rabitq

SCHEMA = "vec_id long, embedding array<double>"


def vectors(kind):
    rng = np.random.default_rng(11)
    if kind == "low rank":
        v = rng.standard_normal((6000, 6)) @ rng.standard_normal((6, 64))
        return v / np.linalg.norm(v, axis=1)[:, None]
    if kind == "clusters of low rank":  # each in a plane of its own
        parts = [rng.standard_normal(64) * 2 + rng.standard_normal((300, 3)) @ rng.standard_normal((3, 64)) for _ in range(20)]
        return np.concatenate(parts)
    if kind == "unequal":
        return rng.standard_normal((6000, 48)) * np.exp(rng.standard_normal((6000, 1)))
    return rng.standard_normal((6000, 32))


def recall(spark, v, **options):
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SCHEMA)
    got = {}
    for r in rabitq.search(df, "vec_id % 20 = 0", k=20, list_rows=100, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    shares = []
    for q in range(0, len(v), 20):
        s = np.cumsum(v * v[q], axis=1)[:, -1]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(v)), -s))[:20]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21)) and all(score == s[i] for _, i, score in own)
        shares.append(len({i for _, i, _ in own} & set(best.tolist())) / 20)
    return np.mean(shares), min(shares)


@pytest.mark.parametrize("kind", ["low rank", "clusters of low rank", "unequal", "round"])
def test_recall(spark, kind):
    v = vectors(kind)
    mean, worst = recall(spark, v)
    assert mean >= 0.97 and worst >= 0.5
    assert recall(spark, v, missed=0) == (1.0, 1.0)


def test_lengths_apart(spark):
    """Vectors of every length are searched among their own."""
    rng = np.random.default_rng(3)
    v = [rng.standard_normal(8 if i < 70 else 5 if i < 100 else 3) for i in range(101)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SCHEMA)
    got = {}
    for r in rabitq.search(df, "vec_id % 20 = 0", k=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for q in range(0, 100, 20):
        own = [i for i in range(101) if len(v[i]) == len(v[q]) and i != q]
        assert [i for _, i in sorted(got[q])] == sorted(own, key=lambda i: (-np.cumsum(v[i] * v[q])[-1], i))[:4]
    assert 100 not in got  # alone of its length


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_repeated_ids(spark, seed):
    """Rows of one id with different texts have classes of their own; against brute force."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(12):
        base = [f"w{rng.integers(500)}" for _ in range(60)]
        for _ in range(5):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(60))] = f"x{rng.integers(10**6)}"
            rows += [(int(rng.integers(25)), " ".join(w))] * int(rng.integers(1, 3))
    rows += [(0, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k l"), (5, "g h i j k l"), (1, None), (1, ""), (None, "a b c d e f"), (7, None)]

    def plain(t):
        w = (t or "").split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None

    least = {}
    for i, t in rows:
        if plain(t) and i is not None:
            least[plain(t)] = min(least.get(plain(t), i), i)
    links = {s: sum(s != u and 10 * len(s & u) >= 8 * len(s | u) for u in least) for s in least}
    want = [(i, least[plain(t)], links[plain(t)]) if plain(t) and i is not None else (i, i, 0) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in fingerprints.linked_rows(df.repartition(3)).select("doc_id", "class_id", "n_links").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and max(w[2] for w in want) >= 2
    assert (1, 1, 0) in got and fingerprints.linked_rows(df.where("false")).count() == 0
