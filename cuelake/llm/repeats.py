"""Passages that occurred before: which windows of a text also start in a smaller doc_id.

Shared by the two operators on repeated passages, which differ in what an element is
(a byte, a word) and in how a block of candidates is searched.

1. Texts are packed into slices of about SLICE bytes and stored.
2. Anchors. A window of WINDOW elements is known by the leftmost of its K-element
   grams with the smallest hash, so equal windows have equal anchors. Each slice sends
   the hashes of its anchors, in buckets by hash, to be counted; back comes one bit for
   each: does it occur in two documents? All else can't repeat and goes no further.
3. Contexts. For each anchor that is shared a slice sends the elements of the windows
   that it stands for to the anchor's bucket. Equal contexts in a slice are sent once,
   for the smallest document; the others of the slice are repeats already. A frequent
   anchor (over FREQUENT occurrences) is split: its windows are sent one by one to
   the buckets of their own hashes, again once for each slice, in the rows that go there
   anyway. So a passage in a third of all documents costs a few windows for each slice.
4. A bucket is solved: for each window the smallest document that has it.
5. The windows found go back to their slices, which have the texts.

Everything sent is packed with zstandard, a row for each slice and bucket. Matches are
exact but for 64-bit hashes, by which a slice knows its own equal contexts; blocks compare
contents. Rows with a null
doc_id neither repeat others nor count as earlier; rows of equal doc_id don't repeat
each other. Null and short texts have no windows.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K
from cuelake.llm.store import stored

WINDOW = 50
#: Bytes of text in a slice, and for each bucket.
SLICE, BUCKET_BYTES = 2 << 20, 4 << 20
FREQUENT = 4096
_ODD = K.random_words(31, 3) | np.uint64(1)
#: Positions that are hashed at once, so that they stay in the cache.
_PIECE = 1 << 15
_PLACE = (1 << 40) - 1


#: Types of arrays that are packed; whole numbers from 0 on go in the first that holds them.
_TYPES = [np.dtype(t) for t in ("u1", "u2", "u4", "i8", "i4", "u8", "?")]


@functools.cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@functools.cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """The arrays compressed: for each three numbers (type, type as sent, length), then their values, each array filled up to eight bytes."""
    head, values = [len(arrays)], []
    for a in arrays:
        kind = sent = _TYPES.index(a.dtype)
        if kind == 3 and len(a) and a.min() >= 0:
            most = int(a.max())
            sent = 0 if most < 1 << 8 else 1 if most < 1 << 16 else 2 if most < 1 << 32 else 3
            a = a.astype(_TYPES[sent])
        head += [kind, sent, len(a)]
        values += [a.tobytes(), bytes(-a.nbytes % 8)]
    return _compressor().compress(b"".join([np.array(head, np.int64).tobytes(), *values]))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = _decompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 3 * n, 8).tolist()
    out, at = [], 8 + 24 * n
    for kind, sent, length in zip(head[::3], head[1::3], head[2::3], strict=True):
        a = np.frombuffer(raw, _TYPES[sent], length, at)
        at += a.nbytes + -a.nbytes % 8
        out.append(a if kind == sent else a.astype(_TYPES[kind]))
    return out


class Text:
    """The texts of a slice as elements. `first` has each text's first element, codes() the hash of ranges of GRAM elements at least."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, offsets: np.ndarray):
        self.ids, self.raw, self.offsets = ids, raw, offsets
        self.rest: pa.RecordBatch | None = None


class Bytes(Text):
    GRAM = 16

    def __init__(self, *args: np.ndarray):
        super().__init__(*args)
        self.first, self.n = self.offsets, len(self.raw)

    def grams(self) -> np.ndarray:
        """The hash of the GRAM bytes from each position on."""
        eight = np.ndarray(self.n - 7, np.dtype("<u8"), self.raw, strides=(1,))
        out = np.empty(len(eight) - 8, np.uint64)
        for at in range(0, len(out), _PIECE):
            h = out[at : at + _PIECE]
            np.multiply(eight[at : at + len(h)], _ODD[0], out=h)
            h ^= h >> np.uint64(29)
            h += eight[at + 8 : at + 8 + len(h)]
            h *= _ODD[1]
            h ^= h >> np.uint64(32)
            h *= _ODD[2]
            h ^= h >> np.uint64(29)
        return out

    def codes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return K.eights_hash(self.raw, lo, hi)

    def contents(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ranges one after the other, length of each)."""
        return K.gather(self.raw, lo, hi), hi - lo


class Words(Text):
    GRAM = 6

    def __init__(self, *args: np.ndarray):
        super().__init__(*args)
        self.start, self.end, self.first = K.words(self.raw, self.offsets)
        self.n = len(self.start)
        self.prefix = K.code_prefix(K.range_hash(K.byte_prefix(self.raw), self.start, self.end))

    def grams(self) -> np.ndarray:
        at = np.arange(self.n - self.GRAM + 1)
        return K.range_hash(self.prefix, at, at + self.GRAM)

    def codes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return K.range_hash(self.prefix, lo, hi)

    def contents(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the ranges, a space after each."""
        number = K.ranges(lo, hi - lo)
        length = self.end[number] - self.start[number] + 1
        out = self.raw[np.minimum(K.ranges(self.start[number], length), len(self.raw) - 1)]
        ends = np.cumsum(length)
        out[ends - 1] = 32
        run = np.concatenate([[0], ends])
        where = np.concatenate([[0], np.cumsum(hi - lo)])
        return out, run[where[1:]] - run[where[:-1]]


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    out = np.empty(len(h) - width + 1, h.dtype)
    for at in range(0, len(out), _PIECE):
        own = out[at : at + _PIECE]
        low, span = h[at : at + len(own) + width - 1], 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        np.minimum(low[: len(own)], low[width - span : width - span + len(own)], out=own)
    return out


def anchors(text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document number in the slice, first window, end of windows) of each anchor: runs of windows with the same anchor."""
    none = np.zeros(0, np.int64)
    if text.n < WINDOW:
        return none.astype(np.uint64), none, none, none
    width = WINDOW - text.GRAM + 1
    h = text.grams()
    low = _sliding_min(h, width)
    # a run ends where the smallest hash changes, where the window has just left the gram that had it, or with its text
    runs = np.ones(len(low), bool)
    runs[1:] = (low[1:] != low[:-1]) | (h[: len(low) - 1] == low[:-1])
    runs[text.first[:-1][text.first[:-1] < len(low)]] = True
    starts = np.flatnonzero(runs)
    owner = np.searchsorted(text.first, starts, side="right") - 1
    # the last WINDOW - 1 elements of a text start no window
    ends = np.minimum(np.append(starts[1:], len(low)), text.first[owner + 1] - WINDOW + 1)
    keep = ends > starts
    starts, ends = starts[keep], ends[keep]
    return low[starts], owner[keep], starts, ends


def slices(docs: DataFrame, rest: list[str] = ()) -> DataFrame:
    """(slice, blob, rest): whole texts with their ids, and the other columns asked for as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        number = pyspark.TaskContext.get().partitionId() << 32
        for b in batches:
            ids = b.column(0).cast(pa.int64())
            known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            raw, offsets = K.strings(b.column(1))
            for lo, hi in K.slices(offsets, SLICE):
                packed = pack(ids[lo:hi], known[lo:hi], offsets[lo : hi + 1] - offsets[lo], raw[offsets[lo] : offsets[hi]])
                others = None
                if rest:
                    out = io.BytesIO()
                    part = b.select(list(rest)).slice(lo, hi - lo)
                    with pa.ipc.new_stream(out, part.schema) as writer:
                        writer.write_batch(part)
                    others = _compressor().compress(out.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed], pa.binary()), pa.array([others], pa.binary())], ["slice", "blob", "rest"])
                number += 1

    return stored(docs.select("doc_id", "text", *rest).mapInArrow(K.releasing(run), "slice long, blob binary, rest binary"))


def _read(blob: bytes, kind: type[Text]) -> tuple[Text, np.ndarray]:
    ids, known, offsets, raw = unpack(blob)
    return kind(ids, raw, offsets), known


def _shared_bits(counted: DataFrame) -> DataFrame:
    """(slice, bucket, bits) for rows (slice, bucket, blob) of sorted hashes: 1 for those that occur twice at least, 2 for frequent ones."""

    def solve(parts: list[tuple[int, bytes]], bucket: int) -> pa.RecordBatch:
        hashes = [unpack(blob)[0] for _, blob in parts]
        every = np.sort(np.concatenate(hashes))
        new = np.ones(len(every), bool)
        new[1:] = every[1:] != every[:-1]
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(every)))
        distinct = every[start]
        bits = [(count[np.searchsorted(distinct, h)]) for h in hashes]
        blobs = [pack(np.packbits(c > 1), np.packbits(c > FREQUENT)) for c in bits]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts]), pa.array([bucket] * len(parts), pa.int32()), pa.array(blobs, pa.binary())], ["slice", "bucket", "bits"])

    return _by_bucket(counted, solve, "slice long, bucket int, bits binary")


def _by_bucket(rows: DataFrame, solve: Callable[[list, int], pa.RecordBatch | None], schema: str) -> DataFrame:
    """solve() over the (slice, blob) pairs of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for b in batches:
            for bucket, number, blob in zip(*(b.column(c).to_pylist() for c in ("bucket", "slice", "blob")), strict=True):
                if bucket != now:
                    if parts and (out := solve(parts, now)) is not None:
                        yield out
                    now, parts = bucket, []
                parts.append((number, blob))
        if parts and (out := solve(parts, now)) is not None:
            yield out

    return rows.repartition("bucket").sortWithinPartitions("bucket", "slice").mapInArrow(K.releasing(run), schema)


def _own_anchors(text: Text, known: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """(document number, windows' begin and end, bucket, rest of the hash) of anchors of documents with an id, sorted by bucket, rest and id: what is counted."""
    h, owner, lo, hi = anchors(text)
    if not known.all():
        keep = known[owner]
        h, owner, lo, hi = h[keep], owner[keep], lo[keep], hi[keep]
    key = (h % np.uint64(buckets)) << np.uint64(32) | h >> np.uint64(32)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = key[1:] != key[:-1]
    tied = np.flatnonzero(~(new[:-1] & new[1:]))
    own = order[tied]
    order[tied] = own[np.lexsort((own, text.ids[owner[own]], key[tied]))]
    return owner[order], lo[order], hi[order], (key >> np.uint64(32)).astype(np.int64), key.astype(np.uint32)


def _distinct_marks(bucket: np.ndarray, rest: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """First of each (bucket, hash, id) in sorted order."""
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1]) | (ids[1:] != ids[:-1])
    return new


Solver = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def repeats(docs: DataFrame, kind: type[Text], solver: Solver, rest: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(slices, found): found has (slice, blob) rows of arrays (first window, end of windows) in elements of the slice.

    solver(contents, lengths, windows, ids) gets contexts one after the other, the
    number of windows and the document of each, and returns for each window the
    smallest document that has it.
    """
    packed = slices(docs, rest)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, blob in zip(b.column("slice").to_pylist(), b.column("blob").to_pylist(), strict=True):
                text, known = _read(blob, kind)
                owner, _, _, bucket, rest = _own_anchors(text, known, buckets)
                new = _distinct_marks(bucket, rest, text.ids[owner])
                bucket, rest = bucket[new], rest[new]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                parts = np.split(rest, cuts[1:]) if len(cuts) else []
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(parts), pa.int64()), pa.array(bucket[cuts], pa.int32()), pa.array([pack(p) for p in parts], pa.binary())], ["slice", "bucket", "blob"])

    bits = _shared_bits(packed.select("slice", "blob").mapInArrow(K.releasing(count), "slice long, bucket int, blob binary"))
    listed = bits.groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))  # one entry for each bucket

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, blob, marks in zip(b.column("slice").to_pylist(), b.column("blob").to_pylist(), b.column("bits").to_pylist(), strict=True):
                if marks:
                    text, known = _read(blob, kind)
                    yield from _contexts(number, text, known, {m["bucket"]: m["bits"] for m in marks}, buckets)

    # the texts are dealt by slice here and in apply(): with the same columns and kind of join the engine does it once
    sent = packed.join(listed, "slice", "left").select("slice", "blob", "rest", "bits").mapInArrow(K.releasing(send), "slice long, bucket int, blob binary")

    def solve(parts: list[tuple[int, bytes]], bucket: int) -> pa.RecordBatch | None:
        if bucket < 0:  # repeats that a slice has found in itself
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts], pa.binary())], ["slice", "blob"])
        every = [unpack(blob) for _, blob in parts]
        ids, lo, windows, length, contents = (np.concatenate([e[k] for e in every]) for k in range(5))
        source = np.repeat(np.arange(len(parts)), [len(e[0]) for e in every])
        order = np.argsort(ids, kind="stable")
        where = np.concatenate([[0], np.cumsum(length)])
        contents = K.gather(contents, where[order], where[order] + length[order])
        ids, lo, windows, length, source = (x[order] for x in (ids, lo, windows, length, source))
        least = solver(contents, length, windows, ids)
        hit = least < np.repeat(ids, windows)
        # places of all parts are sorted as one, each part's after those of the part before
        begin, end = runs(np.sort(K.ranges(source << 40 | lo, windows)[hit]))
        if not len(begin):
            return None
        part, begin, end = begin >> 40, begin & _PLACE, end & _PLACE
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [(parts[part[a]][0], pack(begin[a:z], end[a:z])) for a, z in zip(cuts, np.append(cuts[1:], len(part)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], ["slice", "blob"])

    return packed, _by_bucket(sent, solve, "slice long, blob binary")


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of maximal runs in sorted numbers."""
    if not len(places):
        return places, places
    new = np.ones(len(places), bool)
    new[1:] = places[1:] > places[:-1] + 1
    start = np.flatnonzero(new)
    return places[start], places[np.append(start[1:], len(places)) - 1] + 1


def _contexts(number: int, text: Text, known: np.ndarray, marks: dict[int, bytes], buckets: int) -> Iterator[pa.RecordBatch]:
    """The contexts of shared anchors of a slice by bucket, and what the slice finds in itself under bucket -1."""
    owner, lo, hi, bucket, rest = _own_anchors(text, known, buckets)
    if not len(owner):
        return
    new = _distinct_marks(bucket, rest, text.ids[owner])
    mark_of = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    per = {int(k): int(n) for k, n in zip(*np.unique(bucket[first], return_counts=True), strict=True)}
    bits = [unpack(marks[k]) if k in marks else [np.zeros(-(-n // 8), np.uint8)] * 2 for k, n in per.items()]
    both = [np.concatenate([np.unpackbits(own[j], count=n) for own, n in zip(bits, per.values(), strict=True)]).astype(bool) for j in (0, 1)]
    shared, frequent = both[0][mark_of], both[1][mark_of]
    owner, lo, hi, bucket, frequent = (x[shared] for x in (owner, lo, hi, bucket, frequent))
    if frequent.any():
        often = np.flatnonzero(frequent)
        each = K.ranges(lo[often], hi[often] - lo[often])
        whose = np.repeat(owner[often], hi[often] - lo[often])
        rare = np.flatnonzero(~frequent)
        by_window = text.codes(each, each + WINDOW) % np.uint64(buckets)
        lo, hi = np.concatenate([lo[rare], each]), np.concatenate([hi[rare], each + 1])
        bucket, owner = np.concatenate([bucket[rare], by_window.astype(np.int64)]), np.concatenate([owner[rare], whose])
    if not len(lo):
        return
    ids = text.ids[owner]
    # of equal contexts the smallest document's first one is sent; in larger documents they are repeats
    code = text.codes(lo, hi + WINDOW - 1)
    order = np.lexsort((lo, ids, code, bucket))
    ids, lo, hi, bucket, code = (x[order] for x in (ids, lo, hi, bucket, code))
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (bucket[1:] != bucket[:-1])
    lead = np.flatnonzero(new)
    leader = lead[np.cumsum(new) - 1]
    repeat = ids > ids[leader]
    if repeat.any():
        own = np.unique(K.ranges(lo[repeat], (hi - lo)[repeat]))
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([-1 - number % 997], pa.int32()), pa.array([pack(*runs(own))], pa.binary())], ["slice", "bucket", "blob"])
    again = ~new & ~repeat  # the same document says it twice: each of its places has to be told
    keep = np.flatnonzero(new | again)
    ids, lo, hi, bucket = (x[keep] for x in (ids, lo, hi, bucket))
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    contents, length = text.contents(lo, hi + WINDOW - 1)
    where = np.concatenate([[0], np.cumsum(length)])
    out = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
        out.append((int(bucket[a]), pack(ids[a:b], lo[a:b], hi[a:b] - lo[a:b], length[a:b], contents[where[a] : where[b]])))
    yield pa.RecordBatch.from_arrays([pa.array([number] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], ["slice", "bucket", "blob"])


def covered(n: int, found: list[bytes]) -> np.ndarray:
    """Which of n elements lie in a window found."""
    step = np.zeros(n + 1, np.int32)
    for blob in found:
        lo, hi = unpack(blob)
        np.add.at(step, lo, 1)
        np.add.at(step, hi + WINDOW - 1, -1)
    return np.cumsum(step)[:n] > 0


def apply(packed: DataFrame, found: DataFrame, kind: type[Text], answer: Callable[[Text, np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """answer(texts, ids known, covered elements) over every slice."""
    listed = found.groupBy("slice").agg(F.collect_list("blob").alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob, rest, what in zip(b.column("blob").to_pylist(), b.column("rest").to_pylist(), b.column("found").to_pylist(), strict=True):
                text, known = _read(blob, kind)
                if rest is not None:
                    text.rest = pa.ipc.open_stream(_decompressor().decompress(rest)).read_next_batch()
                yield answer(text, known, covered(text.n, what or []))

    return packed.join(listed, "slice", "left").select("slice", "blob", "rest", "found").mapInArrow(K.releasing(run), schema)
