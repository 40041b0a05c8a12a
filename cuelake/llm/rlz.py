"""Substring dedup by relative Lempel-Ziv parsing over words.

What may repeat is brought together in blocks (see repeats). A block's contexts, in
the order of doc_id, are the reference: a suffix array over its words indexes every
place. Each context is parsed greedily against what the reference has of smaller
documents. A factor is the longest match of all places there: of all earlier places the
one with the longest common prefix is the nearest before or after in the suffix array.
A match of WINDOW words or more is a factor and a duplicate span, and the next factor
starts after it; a word from which no such match starts is a literal. Windows that cross
a factor's end are in no factor as a whole, and their words may stand elsewhere in the
reference; they are checked one by one.

Words are `[^\\x20\\x09-\\x0D]+`, told apart by two independent 64-bit hashes. Null
texts have none. For null ids and repeated rows see repeats. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cuelake.llm import kernels as K
from cuelake.llm import repeats as R

SCHEMA = "doc_id long, n_words long, n_removed long, kept string"
DIGEST_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_SECOND = K.random_words(23, 256)


class Reference:
    """A block's contexts as words, with the places of their windows in the order of what follows."""

    def __init__(self, contents: np.ndarray, length: np.ndarray, ids: np.ndarray):
        start, end, self.first = K.words(contents, np.concatenate([[0], np.cumsum(length)]))
        n, size = len(start), np.diff(self.first)
        self.stop = np.repeat(self.first[1:], size)
        self.owner = np.repeat(ids, size)
        # contexts come in the order of ids: what smaller documents have lies before a document's first word
        new = np.ones(len(ids), bool)
        new[1:] = ids[1:] != ids[:-1]
        self.earlier = np.repeat(self.first[:-1][np.flatnonzero(new)][np.cumsum(new) - 1] if len(ids) else self.first[:0], size)
        codes = [K.range_hash(K.byte_prefix(contents, c), start, end) for c in (K.BYTE_CODE, _SECOND)]
        order = np.lexsort(codes)
        same = np.zeros(n, bool)
        same[1:] = (codes[0][order][1:] == codes[0][order][:-1]) & (codes[1][order][1:] == codes[1][order][:-1])
        self.ranks = [_numbered(order, ~same)]  # of the 1, 2, 4, .. words from each place on, as far as its context goes
        for k in range((int(size.max(initial=1)) - 1).bit_length()):
            key = self.ranks[-1].astype(np.int64) << 32
            after = np.flatnonzero(np.arange(n) + (1 << k) < self.stop)
            key[after] |= self.ranks[-1][after + (1 << k)]
            order = np.argsort(key)
            key = key[order]
            fresh = np.ones(n, bool)
            fresh[1:] = key[1:] != key[:-1]
            self.ranks.append(_numbered(order, fresh))
        self.order = order[self.stop[order] - order >= R.WINDOW].astype(np.int32)
        self.place = np.full(n, -1, np.int32)
        self.place[self.order] = np.arange(len(self.order), dtype=np.int32)
        self.lowest = [self.order]  # the smallest of 1, 2, 4, .. entries of the order from each on
        while 2 << len(self.lowest) - 1 <= len(self.order):
            half = 1 << len(self.lowest) - 1
            self.lowest.append(np.minimum(self.lowest[-1][:-half], self.lowest[-1][half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the contexts have in common from two places on."""
        run = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            one, two = a + run, b + run
            live = np.flatnonzero((one < self.stop[a]) & (two < self.stop[b]))
            same = live[self.ranks[k][one[live]] == self.ranks[k][two[live]]]
            run[same] += 1 << k
        return np.minimum(run, np.minimum(self.stop[a] - a, self.stop[b] - b))

    def longest(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, place) of the longest match of what starts at each place with an earlier document, if it has WINDOW words at least; else 0 words."""
        bound, n = self.earlier[at], len(self.order)
        before = self.place[at].astype(np.int64)
        behind = before + 1
        for j in reversed(range(len(self.lowest))):
            low, step = self.lowest[j], 1 << j
            go = np.flatnonzero(before >= step)
            go = go[low[before[go] - step] >= bound[go]]
            before[go] -= step
            go = np.flatnonzero(behind + step <= n)
            go = go[low[behind[go]] >= bound[go]]
            behind[go] += step
        words, source = np.zeros(len(at), np.int64), at.copy()
        for found, ok in ((before - 1, before > 0), (behind, behind < n)):
            own = np.flatnonzero(ok)
            place = self.order[found[own]].astype(np.int64)
            own, place = own[place < bound[own]], place[place < bound[own]]
            run = self.common(at[own], place)
            better = (run > words[own]) & (run >= R.WINDOW)
            words[own[better]], source[own[better]] = run[better], place[better]
        return words, source


def _numbered(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Numbers from 1 for what stands in order, the next where it is new."""
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new)
    return out


def parse(ref: Reference) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, words, source) of each factor. All contexts are parsed side by side."""
    at, stop = ref.first[:-1].copy(), ref.first[1:]
    found = []
    while len(live := np.flatnonzero(stop - at >= R.WINDOW)):
        words, source = ref.longest(at[live])
        long = words > 0
        found.append((at[live][long], words[long], source[long]))
        at[live] += np.maximum(words, 1)
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(f[k] for f in found)]) for k in range(3))


def least_documents(contents: np.ndarray, length: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window a smaller document that has it, or its own: for windows inside a factor the factor's source, for those across its end what a check finds."""
    ref = Reference(contents, length, ids)
    least = ref.owner.copy()
    place, words, source = parse(ref)
    inside = words - R.WINDOW + 1
    least[K.ranges(place, inside)] = np.repeat(ref.owner[source], inside)
    edge = place + inside
    across = K.ranges(edge, np.maximum(np.minimum(place + words, ref.stop[place] - R.WINDOW + 1) - edge, 0))
    run, met = ref.longest(across)
    least[across[run > 0]] = ref.owner[met[run > 0]]
    return least[K.ranges(ref.first[:-1], windows)]


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of docs: the words kept, joined by a space; or their digest."""
    packed, found = R.repeats(docs, R.Words, least_documents)

    def answer(text: R.Text, known: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        n = np.diff(text.first)
        run = np.concatenate([[0], np.cumsum(gone)])
        removed = run[text.first[1:]] - run[text.first[:-1]]
        out = []
        for t in range(len(n)):
            own = np.arange(text.first[t], text.first[t + 1])[~gone[text.first[t] : text.first[t + 1]]]
            if len(own):
                size = text.end[own] - text.start[own] + 1
                raw = text.raw[np.minimum(K.ranges(text.start[own], size), len(text.raw) - 1)]
                raw[np.cumsum(size) - 1] = 32
                raw = raw[:-1].tobytes()
            else:
                raw = b""
            out.append(hashlib.sha256(raw).hexdigest() if digest else raw.decode())
        return pa.RecordBatch.from_arrays([pa.array(text.ids, mask=~known), pa.array(n), pa.array(removed), pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept"])

    return R.apply(packed, found, R.Words, answer, DIGEST_SCHEMA if digest else SCHEMA)
