"""Periodic runs, Merkle manifests and packing against brute force, with the awkward rows in every one."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from cuelake.llm import merkle, packing, periodic, queries
from cuelake.llm import kernels as K

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# extra columns whose names operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mark int, grp string, at int, size int, length int, sequence_id int, _row int, runs int, kept string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 10, "g", 1, 2, 3, 4, 5, 6, "k") for i, t, lang, s in rows], SCHEMA)


def awkward():
    """Loops of all kinds, nulls in every column, blanks, repeated rows, equal ids with other texts, a long text, odd characters."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        w = []
        while len(w) < 150:
            loop = [f"w{rng.randrange(rng.choice([2, 3, 60]))}" for _ in range(rng.choice([1, 2, 3, 5, 7, 17, 30]))]
            w += loop * rng.randrange(1, 8) + [f"Other{rng.randrange(100)}" for _ in range(rng.randrange(5))]
        rows.append((i, " ".join(w[: rng.randrange(3, 150)]), rng.choice(["nl", "en", None, "日本", "e"]), rng.choice(["a", None])))
    rows += [(70, None, "en", "a"), (71, "", "en", None), (72, " \n\t", None, None), (73, "One", "nl", "a"), (20, "x y x y x y x y x y", "en", "a"), (20, "x y x y x y x y x y", "en", "a"), (None, "b b b b b b b B", "en", "a"), (None, None, None, None)]
    rows += [(74, " ".join(f"V{rng.randrange(10**5)}" for _ in range(20_000)) + " é日本🙂 don't 's<|endoftext|>x1 " + "ab " * 3000, "en", "a"), (75, "A" * 5000, "nl", "b")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, awkward()).repartition(3).cache()


def words_of(i, t):
    w = WORD.findall(t or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def all_runs(w):
    """Every period, every stretch."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_op11_runs(spark, docs):
    want = []
    for i, t, _, _ in awkward():
        w = words_of(i, t)
        runs = all_runs(w) if len(w) < 5000 else None
        if runs is None:  # the long text ends in a loop of one word
            runs = [(len(w) - 3000, 3000, 1)] if zlib.crc32(str(i).encode()) % 10 else None
        assert runs is not None
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
        want.append((i, len(runs), s, length, q, 1000 * length // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in periodic.digests(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(g[1] > 1 for g in got) > 15 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60))
    assert periodic.digests(table(spark, [])).count() == 0


@pytest.mark.parametrize("short", [8, 64])
def test_op11_search(monkeypatch, short):
    """Masking and halving against all periods, on texts made of loops in loops; parts lie side by side."""
    monkeypatch.setattr(periodic, "SHORT", short)
    rng = random.Random(short)
    for _ in range(300):
        w = []
        while len(w) < 300:
            loop = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 4, 6, 17, 18, 40]))]
            w += loop * rng.randrange(1, 9)
            w = w[: len(w) - rng.randrange(0, len(loop))]
        texts = [w, w[:99], [], w[100:]]
        codes = K.mix(np.array([x + 1 for t in texts for x in t], np.uint64))
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = periodic.search(codes, first)
        for k, t in enumerate(texts):
            own = [(int(s - first[k]), int(e - s), int(q)) for s, e, q in got if first[k] <= s < first[k + 1]]
            assert own == sorted(all_runs(t), key=lambda r: (r[0], r[2]))


def test_op11_masking_and_pieces(monkeypatch):
    """Two copies of a passage are no run and are masked; a long text read in pieces has the same words."""
    rng = random.Random(2)
    passage = rng.sample(range(1000), 400)
    codes = K.mix(np.array([*passage, 5000, *passage], np.uint64))
    for lo, hi in (([0], [801]), ([0, 401], [401, 801])):  # in the document every gram of it stands twice, in neither copy one does
        assert not len(periodic.survivors(periodic.grams(codes), np.array(lo), np.array(hi))[0])
    text = np.frombuffer((" ".join("word" * rng.randrange(1, 9) for _ in range(3000)) + "\n").encode(), np.uint8)
    whole = periodic.word_places(text, np.array([0, len(text)]))
    monkeypatch.setattr(periodic, "TOGETHER", 100)
    monkeypatch.setattr(K, "PIECE", 777)
    for a, b in zip(whole, periodic.word_places(text, np.array([0, len(text)])), strict=True):
        assert (a == b).all()


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    """(top, path of (left, right) for each leaf)."""
    paths, where, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, at in enumerate(where):
            run = level[at // 8 * 8 : at // 8 * 8 + 8]
            paths[k].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            where[k] = at // 8
        level = [digest(*level[k : k + 8]) for k in range(0, len(level), 8)]
    return level[0], paths


def manifest(rows):
    own = [(lang, i, digest(told(i, s, lang, len(t or ""), t)), t, s) for i, t, lang, s in rows]
    out, groups = [], sorted({r[0] for r in own}, key=lambda x: (x is not None, (x or "").encode()))
    sorts = {g: sorted((r for r in own if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for g in groups}
    trees = {g: tree([r[2] for r in sorts[g]]) for g in groups}
    root, above = tree([trees[g][0] for g in groups])
    for k, g in enumerate(groups):
        for (lang, i, leaf, t, s), path in zip(sorts[g], trees[g][1], strict=True):
            low = t
            if i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 0:
                low = re.sub("[A-Z]", lambda m: m[0].lower(), t)
            now = digest(told(i, s, lang, len(t or ""), low))
            for before, after in path + above[k]:
                now = digest(before, now, after)
            out.append((i, leaf, trees[g][0], root, digest(*(x for both in path + above[k] for x in both)), now, now == root))
    return out


@pytest.mark.parametrize("levels", [4, 1])
def test_op12_manifest(spark, docs, levels):
    got = [tuple(r) for r in merkle.verified(docs, levels).collect()]
    want = manifest(awkward())
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {g[6] for g in got} == {True, False}
    rows = [(k, f"T{k}", "en", "a") for k in range(9)]  # the last run has one node
    assert sorted((tuple(r) for r in merkle.verified(table(spark, rows)).collect()), key=repr) == sorted(manifest(rows), key=repr)
    one = merkle.verified(table(spark, rows[:1])).first()
    assert one["leaf"] == one["root"] == one["subroot"] and one["proof_sha256"] == digest()
    assert merkle.verified(table(spark, [])).count() == 0


def test_op12_events():
    """Children in any order, in partial parents of any two tasks: the same block."""
    rng, leaves = random.Random(4), [digest(str(k)) for k in range(700)]
    top, paths = tree(leaves)
    for _ in range(5):
        parts = [merkle.Block(700) for _ in range(3)]
        for k in rng.sample(range(700), 700):
            rng.choice(parts).add((k, 700, leaves[k], None))
        block = parts[0].merge(parts[1]).merge(parts[2])
        assert block.top == top and not block.partial
        assert {row[0]: path for row, path in block.paths()} == dict(enumerate(paths))


def test_op12_many_groups(spark):
    """More groups than children of a parent, one of them with most rows."""
    rows = [(k, f"Text {k}", f"l{k % 70}" if k % 3 else "hot", "a") for k in range(400)]
    assert sorted((tuple(r) for r in merkle.verified(table(spark, rows)).collect()), key=repr) == sorted(manifest(rows), key=repr)


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))


def check_packing(got, capacity):
    """Places are gapless in every sequence and within it."""
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_op13_documents(spark, docs, library):
    got = packing.packed_pieces(docs, queries.vocabulary("word_bpe_49k.json")).collect()
    want = []
    for i, t, _, _ in awkward():
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert check_packing(got, 4096) == -(-sum(w[3] for w in want) // 4096)
    assert packing.packed_pieces(table(spark, []), queries.vocabulary("word_bpe_49k.json")).count() == 0


def test_op13_sequences(docs, library):
    """The ids of sequences, put together again by document."""
    packed = packing.pack(packing.pieces(docs, queries.vocabulary("word_bpe_49k.json"), capacity=512), 512)
    rows = packed.collect()
    check_packing(rows, 512)
    held = {r["sequence_id"]: r["ids"] for r in packing.assemble(packed).collect()}
    for r in rows:
        assert held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_op13_encoder(library):
    """Words cut at their inner borders have the ids of the whole text, also in parts of a long one."""
    rng = random.Random(5)
    atoms = ["don", "'t", "'s", "'", "<|startoftext|>", "<|STARTOFTEXT|>", "|", "<", ">", "1", "23", "Word", "É", "é", "̸", "=", "̇", "I", "　", "²", "_", "(", ".", "İ", "🙂", " ", "\n", "\x1c", "\x85", "'LL", "⃣", "٣", "a1b2", "Σ"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randrange(14))) for _ in range(3000)]
    raw, offsets = K.strings(packing.pa.array(texts))
    encoder = packing.Encoder(queries.vocabulary("word_bpe_49k.json"))
    for _ in range(2):
        ids, first = encoder.encode(raw, offsets)
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(first)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def fewest(size, capacity):
    """Exact, by trying all ways for a few items."""
    best = [len(size)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(size):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + size[k] <= capacity:
                place(k + 1, [*bins[:b], bins[b] + size[k], *bins[b + 1 :]])
        place(k + 1, [*bins, size[k]])

    place(0, [])
    return best[0]


def test_op13_search():
    """Squared fills grow with each step; results are as good as the best for a few items and never worse than best fit."""
    rng, lost = random.Random(6), 0
    for _ in range(60):
        size = [rng.randrange(1, 60) for _ in range(9)]
        best = fewest(sorted(size, reverse=True), 100)
        assert packing.least_bins(size, 100) <= best
        bins = packing.solve(size, 100)
        assert sorted(k for b in bins for k in b) == list(range(9)) and max(sum(size[k] for k in b) for b in bins) <= 100
        lost += len(bins) - best
    assert lost <= 2
    size = [rng.randrange(1, 2000) for _ in range(600)]
    start = packing.best_fit(size, range(600), 4096)
    search = packing.Search(size, [list(b) for b in start], 4096, packing.least_bins(size, 4096))
    squares = int((search.fill**2).sum())
    grew, give = [], search.give

    def watched(a):
        nonlocal squares
        done = give(a)
        now = int((search.fill**2).sum())
        grew.append(now > squares if done else now == squares)
        squares = now
        return done

    search.give = watched
    out = search.run()
    assert all(grew) and search.steps > 0 and len(out) < len(start)
    assert sorted(k for b in out for k in b) == list(range(600)) and max(sum(size[k] for k in b) for b in out) <= 4096


def test_op13_rounds(spark, monkeypatch):
    """Groups hand on what they can't fill: with small groups hardly more sequences than the sum allows, copies and equal lengths included."""
    monkeypatch.setattr(packing, "GROUP", 50)
    monkeypatch.setattr(packing, "FAN", 3)
    rng = random.Random(9)
    lengths = [rng.choice([100, 100, 100, rng.randrange(1, 300), 1000]) for _ in range(900)]
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "k long, length long")
    got = packing.pack(rows, 1000).collect()
    assert sorted((r["k"], r["length"]) for r in got) == list(enumerate(lengths))
    assert check_packing(got, 1000) <= -(-sum(lengths) // 1000) + 1
