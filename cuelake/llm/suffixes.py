"""Substring dedup over a suffix array that is built by two-stage sorting.

Texts are UTF-8 bytes. What may repeat is brought together in blocks (see repeats).
In a block the suffix array of the contexts is built in two stages: only suffixes
smaller than their successors are sorted directly, by their first bytes; all others
are induced by going through the buckets of first bytes in order, each placed when
its successor is met. Common prefixes of neighbours then tell equal windows.

A byte is removed if a WINDOW-byte string that covers it also starts in a document
with a smaller doc_id. Null texts are empty. For null ids and repeated rows see
repeats. Other columns are not read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import repeats as R

#: Bytes by which suffixes are told apart; a multiple of 8, WINDOW at least.
SORTED_BYTES = 56

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number, zeros after the end."""
    padded = np.concatenate([text, np.zeros(SORTED_BYTES + 8, np.uint8)])
    return np.ndarray(len(text) + SORTED_BYTES, np.dtype(">u8"), padded, strides=(1,)).astype(np.uint64)


def _by_group(key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order by group, then key: by key first, then two stable passes over 16 bits of the group each."""
    order = np.argsort(key)
    for shift in (0, 16):
        digit = (group[order] >> shift).astype(np.uint16)
        if shift and not digit.any():
            break
        order = order[np.argsort(digit, kind="stable")]
    return order


def sort_directly(at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Positions ordered by their first SORTED_BYTES bytes: by eight bytes, and again by the next eight where those are equal."""
    key = words[at]
    order = np.argsort(key)
    at, key = at[order], key[order]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for depth in range(8, SORTED_BYTES, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(new[where], dtype=np.int32)
        own = at[where]
        key = words[own + depth]
        inner = _by_group(key, group)
        at[where] = own[inner]
        key, group = key[inner], group[inner]
        fresh = np.ones(len(where), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[where] = fresh
    return at


def suffix_array(text: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Positions of text in the order of their suffixes, as far as SORTED_BYTES bytes tell."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int32)
    words = words_at(text) if words is None else words
    differs = np.append(text[:-1] != text[1:], True)
    rises = np.append(text[:-1] < text[1:], False)
    nxt = np.minimum.accumulate(np.where(differs, np.arange(n, dtype=np.int32), np.int32(n - 1))[::-1])[::-1]
    small = rises[nxt]  # smaller than the successor: sorted directly
    direct = sort_directly(np.flatnonzero(small).astype(np.int32), words)
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1], np.int32))
    out = []
    for c in np.unique(text).tolist():
        own = np.concatenate([np.zeros(0, np.int32), *waiting[c]])
        waiting[c] = []
        parts = [own]
        while len(own):  # runs of c induce inside the bucket
            before = own[own > 0] - 1
            own = before[(text[before] == c) & ~small[before]]
            parts.append(own)
        bucket = np.concatenate([*parts, direct[cuts[c] : cuts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before]]
        first = text[before]
        later = first > c
        before, first = before[later], first[later]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        edges = np.flatnonzero(np.diff(first, prepend=-1))
        for k, part in zip(first[edges].tolist(), np.split(before, edges[1:]) if len(edges) else [], strict=True):
            waiting[k].append(part)
    return np.concatenate(out)


def same_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the common prefix of two suffixes has WINDOW bytes at least."""
    same = words[a] == words[b]
    for depth in (*range(8, R.WINDOW - 8, 8), R.WINDOW - 8):
        live = np.flatnonzero(same)
        same[live] = words[a[live] + depth] == words[b[live] + depth]
    return same


def _stand_ins(contents: np.ndarray, where: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each context the first one with the same bytes, as a rule: contexts are told apart by a hash, and those that only have it in common stand for themselves."""
    _, lead, same_as = np.unique(R.K.eights_hash(contents, where[:-1], where[1:]), return_index=True, return_inverse=True)
    stands = lead[same_as]
    # two contexts of equal hash are taken as one only if their bytes agree
    other = np.flatnonzero(stands != np.arange(len(length)))
    mine, theirs = where[other], where[stands[other]]
    agree = length[other] == length[stands[other]]
    eight = np.ndarray(max(len(contents) - 7, 0), np.dtype("<u8"), contents, strides=(1,))
    for k in range(0, int(length.max(initial=0)), 8):
        step = np.minimum(k, length[other] - 8)  # a context has WINDOW bytes at least
        agree &= eight[mine + step] == eight[theirs + step]
    odd = other[~agree]
    stands[odd] = odd
    return stands


def _lone(contents: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which contexts, all different, have an anchor that no other has."""
    where = np.concatenate([[0], np.cumsum(length)])
    if not len(length):
        return np.zeros(0, bool)
    grams = R.Bytes(where, contents, where).grams()
    # a context ends GRAM - 1 bytes after its last gram
    edges = np.stack([where[:-1], where[1:] - R.Bytes.GRAM + 1], axis=1).ravel()
    own = np.minimum.reduceat(np.append(grams, grams[-1]), edges)[::2]
    _, same_as, count = np.unique(own, return_inverse=True, return_counts=True)
    return count[same_as] == 1


def least_documents(contents: np.ndarray, length: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of each context the smallest document with an equal one. Contexts come in the order of ids; all windows of one have the same anchor.

    Equal contexts are sorted once. Equal windows have equal anchors, so a context that then is the
    only one with its anchor has no window of another; it is not sorted.
    """
    where = np.concatenate([[0], np.cumsum(length)])
    stands = _stand_ins(contents, where, length)
    least = np.repeat(ids[stands], windows)
    chosen = np.flatnonzero(stands == np.arange(len(stands)))
    text = R.K.gather(contents, where[chosen], where[chosen + 1])
    met = ~_lone(text, length[chosen])
    text = text[np.repeat(met, length[chosen])]
    chosen = chosen[met]
    at_chosen = np.full(len(ids), -1)
    at_chosen[chosen] = np.arange(len(chosen))
    words = words_at(text)
    start = np.concatenate([[0], np.cumsum(length[chosen])])
    array = suffix_array(text, words)
    begins = R.K.ranges(start[:-1], windows[chosen])
    number = np.full(len(text), -1, np.int32)
    number[begins] = np.arange(len(begins), dtype=np.int32)
    rank = number[array]
    array, rank = array[rank >= 0], rank[rank >= 0]
    owner = np.repeat(ids[chosen], windows[chosen])
    new = np.ones(len(array), bool)
    new[1:] = ~same_prefix(words, array[1:], array[:-1])
    edges = np.flatnonzero(new)
    smallest = np.minimum.reduceat(owner[rank], edges) if len(edges) else np.zeros(0, np.int64)
    by_window = np.empty(len(begins), np.int64)
    by_window[rank] = np.repeat(smallest, np.diff(np.append(edges, len(array))))
    base = np.concatenate([[0], np.cumsum(windows[chosen])])
    sorted_too = at_chosen[stands] >= 0
    own = at_chosen[stands[sorted_too]]
    least[np.repeat(sorted_too, windows)] = by_window[R.K.ranges(base[own], windows[sorted_too])]
    return least


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for each row of docs: spans are maximal removed runs."""
    packed, found = R.repeats(docs, R.Bytes, least_documents)

    def answer(text: R.Text, known: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        heads = text.offsets[:-1][text.offsets[:-1] < text.offsets[1:]]
        edge[heads] = gone[heads]
        removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, edge))
        lo, hi = text.offsets[:-1], text.offsets[1:]
        # a slice has no more bytes than an Arrow batch of binaries can hold
        ends = np.concatenate([[0], np.cumsum(hi - lo - removed[hi] + removed[lo])]).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(ends), pa.py_buffer(text.raw[~gone])])
        return pa.RecordBatch.from_arrays(
            [pa.array(text.ids, mask=~known), pa.array(hi - lo), pa.array(removed[hi] - removed[lo]), pa.array(spans[hi] - spans[lo]), kept],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return R.apply(packed, found, R.Bytes, answer, SCHEMA)


def digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cut_text(kept: bytes) -> str:
    """The text of the bytes kept; bytes of a character that was cut in two go."""
    return kept.decode("utf-8", errors="ignore")


def cut_texts(docs: DataFrame, columns: list[str]) -> DataFrame:
    """docs with the given columns, repeats cut out of their texts and n_chars counted anew. Rows stay, with an empty text if nothing is left.

    The other columns travel with the text, so that rows with equal ids keep their own.
    """
    rest = [c for c in columns if c not in ("doc_id", "text", "n_chars")]
    packed, found = R.repeats(docs, R.Bytes, least_documents, rest)
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns)

    def answer(text: R.Text, known: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        texts = [cut_text(text.raw[a:b][~gone[a:b]].tobytes()) for a, b in zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist(), strict=True)]
        own = {"doc_id": pa.array(text.ids, mask=~known), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
        own |= {c: text.rest.column(c) for c in rest}
        return pa.RecordBatch.from_arrays([own[c] for c in columns], columns)

    return R.apply(packed, found, R.Bytes, answer, schema)
