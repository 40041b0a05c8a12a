"""The steps of repeats (op3, op6) by themselves, without Spark."""

from __future__ import annotations

import numpy as np
import pytest

from cuelake.llm import repeats, suffixes


def texts():
    """Some hundred texts of few words, with copies, shared passages, a run of one letter, short and empty ones."""
    rng = np.random.default_rng(4)
    vocabulary = [f"{w:x}" for w in rng.integers(0, 1 << 16, 90)]
    passage = " ".join(rng.choice(vocabulary, 40))
    out = ["", "a" * 200, "a" * 130, passage, passage[20:], "", "b" * 49, "c" * 50]
    for k in range(100):
        own = " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))))
        out.append(own + passage[k : k + int(rng.integers(40, 120))] if k % 3 else own)
    return [t.encode() for t in [*out, *out[8:40]]]


def as_bytes(raws, ids=None):
    return repeats.Bytes(np.arange(len(raws)) if ids is None else ids, np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raws])]))


def test_pack():
    arrays = [np.array(a) for a in ([], [0, 255], [0, 256], [-1, 3], [1 << 31], [1 << 40, 0])] + [np.zeros(0, np.uint8), np.array([True, False, True]), np.array([7], np.int32), np.array([1 << 63], np.uint64), np.array([5], np.uint32)]
    arrays[0] = arrays[0].astype(np.int64)
    for a, b in zip(arrays, repeats.unpack(repeats.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    assert repeats.unpack(repeats.pack()) == []


def test_anchors():
    """Every window of every text is in one run, and equal windows have equal anchors."""
    raws = texts()
    text = as_bytes(raws)
    h, owner, lo, hi = repeats.anchors(text)
    seen = {}
    for code, doc, a, b in zip(h.tolist(), owner.tolist(), lo.tolist(), hi.tolist(), strict=True):
        for w in range(a, b):
            assert text.offsets[doc] <= w and w + repeats.WINDOW <= text.offsets[doc + 1]
            assert seen.setdefault(text.raw[w : w + repeats.WINDOW].tobytes(), code) == code
    assert (hi - lo).sum() == sum(max(len(r) - repeats.WINDOW + 1, 0) for r in raws)
    assert np.array_equal(np.sort(lo), lo) and (hi[:-1] <= lo[1:]).all()


def sent(text, buckets, frequent):
    """The rows that a slice sends if every anchor is shared, and frequent or not."""
    owner, _, _, bucket, rest = repeats._own_anchors(text, np.ones(len(text.ids), bool), buckets)
    new = repeats._distinct_marks(bucket, rest, text.ids[owner])
    marks = {int(k): repeats.pack(np.packbits(np.ones(n, bool)), np.packbits(np.full(n, frequent))) for k, n in zip(*np.unique(bucket[new], return_counts=True), strict=True)}
    return [row for b in repeats._contexts(0, text, np.ones(len(text.ids), bool), marks, buckets) for row in b.to_pylist()]


@pytest.mark.parametrize("frequent", [False, True])
def test_one_row_for_a_bucket(frequent):
    """Windows of frequent anchors go in the rows of the buckets that other contexts go to: no second set of buckets."""
    rows = [r["bucket"] for r in sent(as_bytes(texts()), 3, frequent) if r["bucket"] >= 0]
    assert sorted(rows) == [0, 1, 2]


@pytest.mark.parametrize("frequent", [False, True])
def test_least_documents(frequent, monkeypatch):
    """Against brute force; copies, and contexts that have their anchor to themselves, are not sorted."""
    raws = texts()
    parts = []
    for k, raw in enumerate(raws):
        text = as_bytes([raw], np.array([k]))
        parts += [repeats.unpack(r["blob"]) for r in sent(text, 1, frequent) if r["bucket"] == 0]
    ids, _, windows, length, contents = (np.concatenate([p[j] for p in parts]) for j in range(5))
    starts = np.concatenate([[0], np.cumsum(length)])
    spelled = [contents[s + w : s + w + repeats.WINDOW].tobytes() for s, n in zip(starts[:-1].tolist(), windows.tolist(), strict=True) for w in range(n)]
    first = {}
    for doc, w in zip(np.repeat(ids, windows).tolist(), spelled, strict=True):
        first.setdefault(w, doc)
    amount = []
    whole = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text, words: (amount.append(len(text)), whole(text, words))[1])
    least = suffixes.least_documents(contents, length, windows, ids)
    assert least.tolist() == [first[w] for w in spelled]
    assert 0 < (least < np.repeat(ids, windows)).sum() < len(least)
    different = {contents[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)}
    assert (amount[0] > 0 or frequent) and amount[0] < sum(map(len, different))


def test_copies_are_not_sorted(monkeypatch):
    raws = [t for t in texts()[8:40] if len(t) >= 50]
    text = as_bytes(raws)
    contents = np.concatenate([text.raw, text.raw])
    length = np.tile(np.diff(text.offsets), 2)
    ids = np.arange(len(length))
    monkeypatch.setattr(suffixes, "_lone", lambda text, length: np.ones(len(length), bool))
    least = suffixes.least_documents(contents, length, length - repeats.WINDOW + 1, ids)
    assert least.tolist() == np.repeat(ids % len(raws), length - repeats.WINDOW + 1).tolist()


def test_none_to_sort():
    none = np.zeros(0, np.int64)
    assert len(suffixes.least_documents(np.zeros(0, np.uint8), none, none, none)) == 0
