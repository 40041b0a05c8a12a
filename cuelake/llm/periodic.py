"""Runs of words that repeat with a period, found by masking and Main-Lorentz.

A run of period q and length L >= max(6, 4 q) has L - q words that stand again q words
on: at least GRAM of them in a row, whatever q is. So each GRAM words that begin in a run
occur twice in the run. Words are masked by this again and again: of a document, then of
each part that is left, only stretches of consecutive grams stay that occur twice in that
same document or part, until nothing more goes. In what is left Main and Lorentz's halving
finds the runs: those across the middle of a part have two periods on one side of it at
least, so candidates for a period are where the gram at the middle stands again; a hash
of two whole periods chooses among them, and words are compared to both ends. Parts of
SHORT words or less are not halved on; words of all of them are compared one period apart.

Words are `[^\\x20\\x09-\\x0D]+`, told apart by 64-bit hashes. Null and empty texts have no
words and no runs; rows are judged each by itself, so that repeated rows and null ids
give repeated results. Other columns are not read. A long text takes some 11 bytes for
each of its bytes; its bytes are worked on in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words in a row that stand again a period on, in every run: the least of max(6, 4 q) - q.
GRAM = min(max(LEAST_WORDS, LEAST_PERIODS * q) - q for q in range(1, LEAST_WORDS))
#: Words of a part that is not halved on.
SHORT = 64
#: Bytes of texts that are worked on together.
TOGETHER = 2 << 20

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"


def least_length(q: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * q)


def word_places(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash of each word, first word of each text); a single long text is read in pieces."""
    if len(raw) <= 2 * TOGETHER or len(offsets) > 2:
        start, end, first = K.words(raw, offsets)
        return start, end, K.range_hash(K.byte_prefix(raw), start, end), first
    kind, before, edges = np.int32 if len(raw) < 1 << 31 else np.int64, False, []
    for at in range(0, len(raw), K.PIECE):
        inside = ~K.SEPARATOR[raw[at : at + K.PIECE]]
        edges.append((np.flatnonzero(np.diff(inside, prepend=before)) + at).astype(kind))
        before = bool(inside[-1])
    edges.append(np.array([len(raw)] if before else [], kind))
    every = np.concatenate(edges)
    codes = np.concatenate(list(K.pieced_words(raw)))
    return every[::2], every[1::2], codes, np.array([0, len(codes)])


def grams(codes: np.ndarray) -> np.ndarray:
    """The hash of the GRAM words from each one on."""
    out = codes[: max(len(codes) - GRAM + 1, 0)] * K.SHINGLE_CODE[0]
    for j in range(1, GRAM):
        out += codes[j : len(codes) - GRAM + 1 + j] * K.SHINGLE_CODE[j]
    return K.mix(out)


def stretches(flag: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of maximal stretches of set flags; new tells where one may not go on from the flag before."""
    begins, ends = flag.copy(), flag.copy()
    begins[1:] &= ~flag[:-1] | new[1:]
    ends[:-1] &= ~flag[1:] | new[1:]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def survivors(gram: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts (lo, hi) of the given ranges of words in which every gram occurs twice."""
    left = None
    while True:
        size = np.maximum(hi - lo - GRAM + 1, 0)
        if not len(size) or int(size.sum()) == left:
            return lo, hi
        left = int(size.sum())
        at, owner = K.ranges(lo, size), np.repeat(np.arange(len(lo), dtype=np.uint64), size)
        key = K.mix(gram[at] ^ (owner * K.SHINGLE_CODE[GRAM]))
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return lo[:0], hi[:0]
        again = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
        new = np.ones(len(at), bool)
        new[1:] = owner[1:] != owner[:-1]
        begin, end = stretches(again, new)
        lo, hi = at[begin], at[end - 1] + GRAM
        keep = hi - lo >= LEAST_WORDS
        lo, hi = lo[keep], hi[keep]


def short_runs(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """(start, end, period) of stretches in short parts, all at once; a stretch may go on beyond its part."""
    at, upto = K.ranges(lo, hi - lo), np.repeat(hi, hi - lo)
    out = []
    for q in range(1, SHORT // LEAST_PERIODS + 1):
        inside = at + q < upto
        same = np.zeros(len(at), bool)
        same[inside] = codes[at[inside]] == codes[at[inside] + q]
        begin, end = stretches(same, np.zeros(len(at), bool))  # the last q words of a part are not set
        long = end - begin >= least_length(q) - q
        s, e = at[begin[long]], at[end[long] - 1] + 1 + q
        out.append(np.stack([s, e, np.full(len(s), q)], axis=1))
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the first elements agree."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        differs = np.flatnonzero(a[done : done + step][: n - done] != b[done : done + step][: n - done])
        if len(differs):
            return done + int(differs[0])
        done, step = done + step, 2 * step
    return n


def _others(q: np.ndarray, m: int, side: int, run: tuple[int, int, int]) -> np.ndarray:
    """The candidates that don't give a run again by a multiple of its period."""
    begin = m if side > 0 else m - 2 * q
    return q[(q % run[2] != 0) | (begin < run[0]) | (begin + 2 * q > run[1])]


def across(codes: np.ndarray, gram: np.ndarray, prefix: np.ndarray, part: tuple[int, int], lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
    """The runs across the middle of lo to hi, carried on to both ends of the part that it belongs to."""
    m, most = (lo + hi) // 2, (hi - lo) // LEAST_PERIODS
    found: list[tuple[int, int, int]] = []
    for side in (1, -1):
        upto = min(most, ((hi - m) if side > 0 else (m - lo)) // 2)
        if upto < 1:
            continue
        few = np.arange(1, min(GRAM - 1, upto) + 1)
        if side > 0:
            more = np.flatnonzero(gram[m + GRAM : m + upto + 1] == gram[m]) + GRAM if upto >= GRAM else few[:0]
        else:
            more = np.flatnonzero(gram[m - GRAM - upto : m - 2 * GRAM + 1][::-1] == gram[m - GRAM]) + GRAM if upto >= GRAM else few[:0]
        q = np.concatenate([few, more])
        a = np.full(len(q), m) if side > 0 else m - 2 * q
        q = q[K.range_hash(prefix, a, a + q) == K.range_hash(prefix, a + q, a + 2 * q)]
        for run in found:
            q = _others(q, m, side, run)
        while len(q):
            p, q = int(q[0]), q[1:]
            # words i and i + p agree from `first` on; from there to both sides
            first = m if side > 0 else m - p
            right = first + _agree(codes[first : part[1] - p], codes[first + p : part[1]])
            left = first - _agree(codes[part[0] : first][::-1], codes[part[0] + p : first + p][::-1])
            if right + p - left >= least_length(p):
                found.append((left, right + p, p))
                q = _others(q, m, side, found[-1])
    yield from found


def runs_in(codes: np.ndarray, gram: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(start, end, smallest period) of all runs in the parts, by start and end."""
    prefix = K.code_prefix(codes) if len(lo) else np.zeros(1, np.uint64)
    short_lo, short_hi, parts, found = [], [], [], []
    waiting = [(a, b, number) for number, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True))]
    while waiting:
        a, b, number = waiting.pop()
        if b - a <= SHORT:
            short_lo.append(a)
            short_hi.append(b)
            parts.append(number)
        else:
            found += across(codes, gram, prefix, (int(lo[number]), int(hi[number])), a, b)
            waiting += [(a, (a + b) // 2, number), ((a + b) // 2, b, number)]
    every = [np.array(found, np.int64).reshape(-1, 3)]
    if short_lo:
        order = np.argsort(np.array(short_lo), kind="stable")
        own_lo, own_hi = np.array(short_lo)[order], np.array(short_hi)[order]
        within = np.array(parts)[order]
        # those that go on beyond their piece lie across a middle and are found there; parts may share words, so pieces go by part
        for piece in (within % 2 == 0, within % 2 == 1):
            got = np.concatenate(short_runs(codes, own_lo[piece], own_hi[piece]) or [every[0][:0]])
            if len(got):
                s, e, q = got.T
                k = np.searchsorted(own_lo[piece], s, side="right") - 1
                whose = within[piece][k]
                on_left = (s > lo[whose]) & (codes[np.maximum(s - 1, 0)] == codes[np.maximum(s - 1, 0) + q])
                on_right = (e < hi[whose]) & (codes[np.minimum(e, len(codes) - 1)] == codes[np.minimum(e, len(codes) - 1) - q])
                every.append(got[~on_left & ~on_right])
    out = np.concatenate(every)
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    return out[new]


def looped(n: int, mark: int) -> np.ndarray:
    """Word numbers of a text of n words that ends in a loop: from word a = g % n on, where g = mark // 10, its first p = 1 + (n - a) // (3 + g % 8) words over and over."""
    g = mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def search(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs of texts whose words begin at `first`, by start, then period."""
    gram = grams(codes)
    out = runs_in(codes, gram, *survivors(gram, first[:-1], first[1:]))
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _kept_bytes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, number: np.ndarray, at_once: int = 1 << 18) -> bytes:
    """The words of these numbers, joined by one space."""
    out = []
    for at in range(0, len(number), at_once):
        own = number[at : at + at_once]
        length = (end[own] - start[own]).astype(np.int64) + 1
        part = raw[np.minimum(K.ranges(start[own].astype(np.int64), length), len(raw) - 1)]
        part[np.cumsum(length) - 1] = 32
        out.append(part.tobytes())
    return b"".join(out)[:-1]


def _answer(ids: pa.Array, marks: np.ndarray | None, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    start, end, codes, first = word_places(raw, offsets)
    number = None
    if marks is not None:
        for t in np.flatnonzero((marks >= 0) & (marks % 10 == 0) & (first[1:] > first[:-1])).tolist():
            number = np.arange(len(codes)) if number is None else number
            number[first[t] : first[t + 1]] = first[t] + looped(int(first[t + 1] - first[t]), int(marks[t]))
    if number is not None:
        codes = codes[number]
    found = search(codes, first)
    step = np.zeros(len(codes) + 1, np.int32)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 1], -1)
    stays = np.cumsum(step)[:-1] == 0
    kept = []
    for t in range(len(first) - 1):
        own = np.flatnonzero(stays[first[t] : first[t + 1]]) + first[t]
        kept.append(_kept_bytes(raw, start, end, own if number is None else number[own]))
    per = np.searchsorted(found[:, 0], first)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(per))
    values = pa.StructArray.from_arrays([pa.array(found[:, 0] - first[owner]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(per, pa.int32()), values), pa.array(kept, pa.binary())],
        ["doc_id", "n_words", "runs", "kept"],
    )


def collapse(docs: DataFrame, mark: Column | None = None) -> DataFrame:
    """(doc_id, n_words, runs, kept) for each row of docs.

    runs are (start, length, period) in words, by start, then period; kept has the
    words that lie in no run after its first period, joined by one space. Where a
    mark is given and divisible by 10, the text is looped first (see looped); a null
    mark leaves it as it is.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.lit(-1) if mark is None else F.coalesce(mark, F.lit(-1))).cast("long").alias("mark"))

    marked = mark is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = K.strings(b.column("text"))
            marks = b.column("mark").to_numpy(zero_copy_only=False)
            for lo, hi in K.slices(offsets, TOGETHER):
                yield _answer(b.column("doc_id").slice(lo, hi - lo), marks[lo:hi] if marked else None, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])

    return read.mapInArrow(K.releasing(run), SCHEMA)


def digests(docs: DataFrame) -> DataFrame:
    """Texts of which every tenth, by the checksum of its id, is looped: number of runs, the longest one, and digests of all runs and of the words kept."""
    of_id = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    told = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return collapse(docs, of_id).withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.p")).alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
