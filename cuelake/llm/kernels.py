"""Vectorised numpy kernels over Arrow string batches.

Texts stay in the Arrow buffer as UTF-8; no Python string is made unless an
operator needs one. A null text counts as empty throughout.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Word separators are x20 and x09-x0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
#: Bytes of a long text that are worked on at once.
PIECE = 1 << 20


def random_words(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, size=n, dtype=np.uint64)


BYTE_CODE = random_words(7, 256)
SHINGLE_CODE = random_words(11, 64) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown on demand, kept up to 4 M entries."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            np.multiply(have[:done], step, out=have[done : 2 * done])
            done *= 2
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary())
    if binary.null_count:
        binary = binary.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(binary.type) else np.int32
    _, where, data = binary.buffers()
    offsets = np.frombuffer(where, dtype=kind)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64) if len(binary) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about `size` bytes; a longer text is a run of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        upto = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        upto = min(n, max(upto, at + 1))
        yield at, upto
        at = upto


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of each word, and for each text the number of its first word, with the total at the end."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    heads = offsets[:-1][(offsets[:-1] < n) & (offsets[1:] > offsets[:-1])]
    begins[heads] = inside[heads]
    tails = heads[1:] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def byte_prefix(raw: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """Prefix sums of code[byte] * multiplier**position, for the hash of any range."""
    out = np.empty(len(raw) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(code[raw] * powers(_MULTIPLIER, len(raw)), out=out[1:])
    return out


def code_prefix(codes: np.ndarray) -> np.ndarray:
    """The same over 64-bit codes of elements."""
    out = np.empty(len(codes) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(codes * powers(_MULTIPLIER, len(codes)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges; equal contents have equal hashes wherever they lie."""
    return mix((prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start] + (end - start).astype(np.uint64))


def eights_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of eight bytes at least, eight bytes at a time; equal contents have equal hashes wherever they lie. For many short ranges."""
    eight = np.ndarray(max(len(raw) - 7, 0), np.dtype("<u8"), raw, strides=(1,))
    size = end - start
    out = size.astype(np.uint64)
    for k in range(0, int(size.max(initial=0)), 8):  # the last eight bytes of a shorter range come again
        out ^= eight[start + np.minimum(k, size - 8)]
        out *= np.uint64(_MULTIPLIER)
        out ^= out >> np.uint64(29)
    return mix(out)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text)."""
    code = BYTE_CODE[LOWER] if lower else BYTE_CODE
    start, end, first = words(raw, offsets)
    return range_hash(byte_prefix(raw, code), start, end), first


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each k-word shingle, first shingle of each text). A text of 1 to k-1 words has one shingle, of all its words."""
    count = np.diff(first)
    per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    where = np.concatenate([[0], np.cumsum(per)])
    out = np.empty(int(where[-1]), dtype=np.uint64)
    if len(hashes) >= k:
        every = hashes[: len(hashes) - k + 1] * SHINGLE_CODE[0]
        for j in range(1, k):
            every = every + hashes[j : len(hashes) - k + 1 + j] * SHINGLE_CODE[j]
        full = np.flatnonzero(count >= k)
        take = _ranges(first[full], per[full])
        out[_ranges(where[full], per[full])] = every[take]
    for t in np.flatnonzero((count > 0) & (count < k)):
        own = hashes[first[t] : first[t + 1]]
        out[where[t]] = (own * SHINGLE_CODE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), where


def pieced_words(raw: np.ndarray, lower: bool = False, piece: int = PIECE) -> Iterator[np.ndarray]:
    """The hashes of one text's words, as word_hashes has them, in runs: works on `piece` bytes at once, also inside a word, so that memory does not grow with the text."""
    code = BYTE_CODE[LOWER] if lower else BYTE_CODE
    open_sum, open_length = np.uint64(0), 0
    with np.errstate(over="ignore"):
        for at in range(0, len(raw), piece):
            part = raw[at : at + piece]
            start, end, _ = words(part, np.array([0, len(part)]))
            prefix = byte_prefix(part, code)
            sums = (prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start]
            length = end - start
            if open_length:
                if len(start) and start[0] == 0:
                    sums[0] = open_sum + sums[0] * np.uint64(pow(_MULTIPLIER, open_length, 1 << 64))
                    length[0] += open_length
                else:
                    sums, length = np.append(open_sum, sums), np.append(open_length, length)
                open_length = 0
            if len(end) and end[-1] == len(part) and at + piece < len(raw):
                open_sum, open_length = sums[-1], int(length[-1])
                sums, length = sums[:-1], length[:-1]
            yield mix(sums + length.astype(np.uint64))
        if open_length:
            yield mix(np.array([open_sum]) + np.uint64(open_length))


def pieced_shingles(raw: np.ndarray, lower: bool = False, k: int = 5, piece: int = PIECE) -> Iterator[np.ndarray]:
    """The hashes of one text's k-word shingles, as shingle_hashes has them, in runs of bounded size."""
    before, any_full = np.zeros(0, np.uint64), False
    for own in pieced_words(raw, lower, piece):
        own = np.concatenate([before, own])
        if len(own) >= k:
            any_full = True
            yield shingle_hashes(own, np.array([0, len(own)]), k)[0]
        before = own[-(k - 1) :]
    if len(before) and not any_full:
        yield shingle_hashes(before, np.array([0, len(before)]), k)[0]


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, .. for length[0] numbers, then the next range, and so on."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = length > 0
    start, length = start[keep], length[keep]
    step = np.ones(total, dtype=np.int64)
    step[0] = start[0]
    at = np.cumsum(length)[:-1]
    step[at] = start[1:] - (start[:-1] + length[:-1] - 1)
    return np.cumsum(step)


ranges = _ranges


def gather(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of many short ranges one after the other."""
    whole = raw.tobytes()
    return np.frombuffer(b"".join([whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]), np.uint8)


def segment_min(values: np.ndarray, where: np.ndarray, empty: int) -> np.ndarray:
    """Minimum of values[where[i]:where[i+1]], or `empty`."""
    out = np.full(len(where) - 1, empty, dtype=values.dtype)
    full = np.flatnonzero(np.diff(where) > 0)
    if len(full):
        out[full] = np.minimum.reduceat(values, where[:-1][full])
    return out


class Permutations:
    """`n` universal hash permutations x -> a x + b modulo 2**32, a odd."""

    def __init__(self, n: int, seed: int = 1):
        draw = random_words(1000 + seed, 2 * n)
        self.a = (draw[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.b = (draw[n:] >> np.uint64(32)).astype(np.uint32)

    def signatures(self, shingles: np.ndarray, where: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        """The minimum of each permutation over each text's shingles; all bits set for a text without any. Runs over pieces that fit the cache, so memory does not grow with a text."""
        n, k = len(where) - 1, len(self.a)
        out = np.full((n, k), 0xFFFFFFFF, dtype=np.uint32)
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        for lo in range(0, len(x), chunk):
            hi = min(len(x), lo + chunk)
            own = np.arange(np.searchsorted(where, lo, side="right") - 1, np.searchsorted(where, hi, side="left"))
            own = own[where[own + 1] > where[own]]
            cuts = np.maximum(where[own], lo) - lo
            buffer, part = np.empty(hi - lo, np.uint32), x[lo:hi]
            for j in range(k):
                np.multiply(part, self.a[j], out=buffer)
                buffer += self.b[j]
                out[own, j] = np.minimum(out[own, j], np.minimum.reduceat(buffer, cuts))
        return out


def intersections(sets: list[np.ndarray], block: int = 512, half: int = 0) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(lo, hi, after, counts): for a block of sorted distinct sets, lo to hi, the sizes of their intersections with all sets from `after` on.

    Shingles that many sets share are counted by a matrix product, rarer ones pair by
    pair. With `half` only the first so many sets are held against only the others.
    """
    m = len(sets)
    every, owner = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(every)))
    number = np.repeat(np.arange(len(start)), count)
    many = count > max(8, m // 32)
    rare = (count > 1) & ~many
    column = np.cumsum(many) - 1
    in_many = many[number]
    d_row, d_col = owner[in_many], column[number[in_many]]
    width = int(many.sum())
    r_owner, r_number = owner[rare[number]], number[rare[number]]
    for lo in range(0, half or m, block):
        hi = min(half or m, lo + block)
        after = half or lo
        met = np.zeros((hi - lo, m - after), np.float32)
        for c in range(0, width, 1024):
            part = np.flatnonzero((d_col >= c) & (d_col < c + 1024) & (d_row >= lo))
            dense = np.zeros((m - lo, min(1024, width - c)), np.float32)
            dense[d_row[part] - lo, d_col[part] - c] = 1
            met += dense[: hi - lo] @ dense[after - lo :].T
        # the owners of a shingle are in ascending order; pairs are added where they belong, so that memory is bounded by the block
        at, delta = np.flatnonzero((r_owner >= lo) & (r_owner < hi)), 1
        while True:
            at = at[at + delta < len(r_owner)]
            at = at[r_number[at] == r_number[at + delta]]
            if not len(at):
                break
            own = at[r_owner[at + delta] >= after]
            np.add.at(met, (r_owner[own] - lo, r_owner[own + delta] - after), 1)
            delta += 1
        yield lo, hi, after, met


def code_points(raw: np.ndarray) -> np.ndarray:
    """Byte positions at which code points begin."""
    return np.flatnonzero((raw & 0xC0) != 0x80)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which a worker that idles until its next task gives freed memory back."""

    @functools.wraps(run)
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # of glibc
                trim(0)

    return own
