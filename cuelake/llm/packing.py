"""Packing documents into as few sequences as can be, by local search.

1. Texts become ids of the tokenizers library, then END. Distinct words of a stretch of
   text are encoded once and ids looked up: the vocabulary's splitting never joins what
   white space parts. Only documents over `capacity` are cut, into pieces of just that.
2. Full pieces are sequences. The others are dealt at random into groups of about GROUP.
   A group starts with best fit, by descending length or in the order dealt, whichever
   has fewer bins, then goes from bin to bin, the least full first: it gives documents away to fuller bins, one against none, one or two
   smaller ones, or two against none or a smaller one, so that the sum of squared fills
   grows, until bins are empty. It ends at a number of bins that no packing goes below,
   or where no exchange is left.
3. What no group can save alone is saved together: each group hands on its least full
   bins, as far as their room adds up to one sequence (CARRIED bins at most); FAN groups
   meet in one of the next round, until one is left. So at most as many bins are lost as
   one group loses.

Groups are bounded, nothing else is brought together. Null texts are empty and have END
alone; repeated rows and rows without an id are packed one by one. An empty table gives
an empty result. A long text is encoded in parts of PART bytes; one word is never cut,
and takes some 100 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K
from cuelake.llm.store import stored

CAPACITY, END = 4096, 1
#: Pieces in a group; groups that meet in the next round; bins that a group hands on at most.
GROUP, FAN, CARRIED = 4096, 64, 32
#: Bytes of text that are encoded together; words that a task keeps.
PART, KEPT_WORDS = 2 << 20, 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _cut_classes() -> tuple[np.ndarray, np.ndarray]:
    """(class of each byte, whether a word may be cut between two classes). Classes: 0 not ASCII, 1 letter, 2 digit, 3 mark, 4 apostrophe, 5 bar."""
    of = np.full(256, 3, np.uint8)
    of[128:] = 0
    of[[*range(65, 91), *range(97, 123)]] = 1
    of[48:58] = 2
    of[[39, 124]] = 4, 5
    may = np.zeros((6, 6), bool)
    may[2, 1:], may[1:, 2] = True, True
    may[1, [3, 4]], may[3, 1] = True, True
    return of, may.ravel()


_CLASS, _MAY_CUT = _cut_classes()


def bits(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As kernels.words, but words are also cut where the vocabulary's pattern surely parts them, so that fewer are distinct: around ASCII digits, after ASCII letters, and before them but after an apostrophe, which may begin 's or 't. A bar is cut from digits only, as added tokens have bars next to letters."""
    start, end, _ = K.words(raw, offsets)
    of = _CLASS[raw]
    cut = np.flatnonzero(_MAY_CUT[of[:-1] * 6 + of[1:]]) + 1
    if len(start):
        word = np.searchsorted(start, cut, side="right") - 1
        cut = cut[(word >= 0) & (cut > start[word]) & (cut < end[word])]
    else:
        cut = cut[:0]
    start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return start, end, np.searchsorted(start, offsets)


class Encoder:
    """Ids of texts by way of their distinct words, which are kept from one stretch of text to the next."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.forget()

    def forget(self) -> None:
        self.known, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        own = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.array([len(x) for x in own], np.int64)
        start = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(own), np.int32, int(length.sum()))])
        every = np.concatenate([self.known, hashes])
        order = np.argsort(every)
        self.known, self.start, self.length = every[order], np.concatenate([self.start, start])[order], np.concatenate([self.length, length])[order]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text with the total at the end)."""
        start, end, first = bits(raw, offsets)
        hashes = K.range_hash(K.byte_prefix(raw), start, end)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > KEPT_WORDS:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
        if len(new):
            data = raw.tobytes()
            self._learn(distinct[new], [data[start[k] : end[k]].decode() for k in example[new].tolist()])
        at = np.searchsorted(self.known, distinct)[which] if len(distinct) else np.zeros(0, np.int64)
        length = self.length[at]
        run = np.concatenate([[0], np.cumsum(length)])
        return self.ids[K.ranges(self.start[at], length)], run[first]


def _parts(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of PART bytes or more, cut at white space."""
    at = 0
    while at < len(raw):
        upto = min(len(raw), at + PART)
        while upto < len(raw):
            found = np.flatnonzero(K.SEPARATOR[raw[upto : upto + PART]])
            if len(found):
                upto += int(found[0])
                break
            upto = min(len(raw), upto + PART)
        yield raw[at:upto]
        at = upto


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """PIECES for each row of docs: its ids and `end`, cut where they are more than `capacity`. ids is null if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = Encoder(vocabulary), np.array([end], np.int32)
        for b in batches:
            raw, offsets = K.strings(b.column("text"))
            for lo, hi in K.slices(offsets, PART):
                own = raw[offsets[lo] : offsets[hi]]
                if hi == lo + 1 and len(own) > 2 * PART:
                    ids = np.concatenate([encoder.encode(part, np.array([0, len(part)]))[0] for part in _parts(own)])
                    first = np.array([0, len(ids)])
                else:
                    ids, first = encoder.encode(own, offsets[lo : hi + 1] - offsets[lo])
                names, out = b.column("doc_id").slice(lo, hi - lo).to_pylist(), []
                for name, x, y in zip(names, first[:-1].tolist(), first[1:].tolist(), strict=True):
                    every = np.concatenate([ids[x:y], last])
                    for k in range(0, len(every), capacity):
                        part = every[k : k + capacity]
                        out.append((name, k // capacity, k, len(part), zlib.crc32(part.astype("<u4").tobytes()), part if with_ids else None))
                columns = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(K.releasing(run), PIECES)


def best_fit(size: list[int], order: Iterable[int], capacity: int) -> list[list[int]]:
    """Items of each bin: each goes where it leaves least room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin has room r
    for k in order:
        fits = rooms >> size[k]
        if fits:
            room = size[k] + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[chosen].append(k)
        else:
            room, chosen = capacity, len(bins)
            bins.append([k])
        room -= size[k]
        if room:
            by_room[room].append(chosen)
            rooms |= 1 << room
    return bins


def _choices(items: list[int], size: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum, item, other item) of none, one or two items of a bin, one for each sum of the same number; -1 for no item. A bin has few distinct sizes, as they add up."""
    by_size = {size[k]: k for k in items}
    twin = {}
    for k in items:
        if by_size[size[k]] != k:
            twin[size[k]] = k
    s = np.array(sorted(by_size), np.int64)
    one = np.array([by_size[x] for x in s.tolist()], np.int64)
    other = np.array([twin.get(x, -1) for x in s.tolist()], np.int64)
    i, j = np.triu_indices(len(s), 1)
    double = np.flatnonzero(other >= 0)
    pair = np.concatenate([s[i] + s[j], 2 * s[double]])
    pair, lead = np.unique(pair, return_index=True)
    a, b = np.concatenate([one[i], one[double]])[lead], np.concatenate([one[j], other[double]])[lead]
    none = np.full(len(s) + 1, -1, np.int64)
    return np.concatenate([[0], s, pair]), np.concatenate([[-1], one, a]), np.concatenate([none, b])


def least_bins(size: list[int], capacity: int) -> int:
    """Bins that no packing goes below: the sum, rounded so that what exceeds 1/(k+1) of a bin counts 1/k, and with large items counted whole where small ones of up to e are left out."""
    count = np.bincount(np.array(size, np.int64), minlength=capacity + 1)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(1, 41):
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity) of a bin
        worth = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * worth).sum()) // (k * capacity)))
    below = np.cumsum(count * x)
    above = np.cumsum(count[::-1])[::-1]
    e = np.arange(1, capacity // 2 + 1)
    large = np.append(above, 0)[capacity - e + 1]
    middle = below[capacity - e] - below[e - 1]
    return max(best, int((large + -(-middle // capacity)).max(initial=0)))


class Search:
    """Local search over the bins of a group. Entries are what an underfull bin could give back: none, one or two of its items."""

    def __init__(self, size: list[int], bins: list[list[int]], capacity: int, least: int):
        self.size, self.bins, self.capacity, self.least = size, bins, capacity, least
        self.fill = np.array([sum(size[k] for k in items) for items in bins], np.int64)
        self.live, self.steps = len(bins), 0
        self.place: dict[int, tuple[int, int]] = {}
        self.back, self.one, self.two, self.owner = (np.zeros(0, np.int64) for _ in range(4))
        self.enter([b for b in range(len(bins)) if self.fill[b] < capacity])

    def enter(self, changed: list[int]) -> None:
        """Entries of changed bins anew, after the others; the old ones are void."""
        for b in changed:
            lo, hi = self.place.pop(b, (0, 0))
            self.owner[lo:hi] = -1
        if 2 * (self.owner < 0).sum() > len(self.owner):
            changed = [*self.place, *changed]
            self.place = {}
            self.back, self.one, self.two, self.owner = (np.zeros(0, np.int64) for _ in range(4))
        changed = [b for b in changed if 0 < self.fill[b] < self.capacity]
        every, at = [_choices(self.bins[b], self.size) for b in changed], len(self.owner)
        for b, own in zip(changed, every, strict=True):
            self.place[b] = (at, at + len(own[0]))
            at += len(own[0])
        self.back, self.one, self.two = (np.concatenate([now, *(own[k] for own in every)]) for k, now in enumerate((self.back, self.one, self.two)))
        self.owner = np.concatenate([self.owner, *(np.full(len(own[0]), b) for b, own in zip(changed, every, strict=True))])

    def give(self, a: int) -> bool:
        """The exchange that takes most out of bin a into a bin that is no less full, if there is one."""
        lo, hi = self.place[a]
        amount, mine, also = self.back[lo + 1 : hi], self.one[lo + 1 : hi], self.two[lo + 1 : hi]
        entry = np.flatnonzero((self.owner >= 0) & (self.owner != a) & (self.fill[self.owner] >= self.fill[a]))
        back, reach = self.back[entry], self.back[entry] + self.capacity - self.fill[self.owner[entry]]
        gain, choice = np.zeros(len(amount), np.int64), np.zeros(len(amount), np.int64)
        none = np.iinfo(np.int64).max
        # two items are given against one or none, one item also against two
        for asked, offered in ((also < 0, slice(None)), (also >= 0, self.two[entry] < 0)):
            best = np.full(self.capacity + 1, none)
            np.minimum.at(best, reach[offered], (back * (len(self.owner) + 1) + entry)[offered])
            key = np.minimum.accumulate(best[::-1])[::-1][amount[asked]]
            known = key < none
            gain[asked] = np.where(known, amount[asked] - key // (len(self.owner) + 1), 0)
            choice[asked] = np.where(known, key % (len(self.owner) + 1), 0)
        if not len(gain) or gain.max() <= 0:
            return False
        k = int(np.argmax(gain))
        d, c = int(gain[k]), int(choice[k])
        b = int(self.owner[c])
        for item, source, target in ((mine[k], a, b), (also[k], a, b), (self.one[c], b, a), (self.two[c], b, a)):
            if item >= 0:
                self.bins[source].remove(int(item))
                self.bins[target].append(int(item))
        self.fill[a] -= d
        self.fill[b] += d
        self.live -= int(self.fill[a] == 0)
        self.steps += 1
        self.enter([a, b])
        return True

    def run(self) -> list[list[int]]:
        """Exchanges until no more bin can be empty, or none is left."""
        every = False
        while self.live > self.least:
            under = sorted(self.place, key=lambda b: (self.fill[b], b))
            helped = False
            # as many of the least full as must go; any of the others where those have no exchange
            for a in under if every else under[: self.live - self.least]:
                while self.live > self.least and a in self.place and self.give(a):
                    helped = True
                if helped and every:
                    break
            if not helped and every:
                break
            every = not helped
        return [items for items in self.bins if items]


def solve(size: list[int], capacity: int, before: list[list[int]] | None = None) -> list[list[int]]:
    """Bins of items: local search from best fit by descending length or in the order given, whichever has fewer bins. Never more bins than `before` has."""
    least = least_bins(size, capacity)
    down = sorted(range(len(size)), key=lambda k: -size[k])
    start = min((best_fit(size, order, capacity) for order in (down, range(len(size)))), key=len)
    out = Search(size, start, capacity, least).run() if len(start) > least else start
    if before is not None and len(before) < len(out):
        out = before
    return out


def _handed_on(bins: list[list[int]], size: list[int], capacity: int) -> set[int]:
    """The least full bins, as far as their room adds up to a sequence."""
    out, room = set(), 0
    for fill, b in sorted((sum(size[k] for k in items), b) for b, items in enumerate(bins)):
        if room >= capacity or len(out) == CARRIED or fill == capacity:
            break
        out.add(b)
        room += capacity - fill
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows, which have `length` (1 to capacity), with sequence_id and offset: places in sequences, without gaps from 0. Other columns pass."""
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    full = F.col("length") == capacity
    out = rows.where(full).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    n = rows.where(~full).count()
    groups = -(-n // GROUP)
    if not n:
        return out.drop("_row")
    now = rows.where(~full).withColumn("grp", F.pmod(F.xxhash64("_row"), F.lit(groups))).withColumn("sequence_id", F.lit(None).cast("long")).withColumn("offset", F.lit(0).cast("long")).withColumn("handed_on", F.lit(False))
    names = rows.columns
    for number in range(64):
        ends, step = groups == 1, number << 52

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("_row")
            size = table.column("length").to_pylist()
            before = None
            if table.column("sequence_id").null_count == 0:
                _, which = np.unique(table.column("sequence_id").to_numpy(), return_inverse=True)
                before = [np.flatnonzero(which == b).tolist() for b in range(which.max() + 1)]
            bins = solve(size, capacity, before)
            on = set() if ends else _handed_on(bins, size, capacity)
            grp = table.column("grp")[0].as_py()
            sequence, offset, handed = (np.zeros(len(size), t) for t in (np.int64, np.int64, bool))
            for b, items in enumerate(bins):
                at = 0
                for k in sorted(items):
                    sequence[k], offset[k], handed[k] = step + (grp << 20) + b, at, b in on
                    at += size[k]
            own = {"sequence_id": sequence, "offset": offset, "handed_on": handed}
            return pa.table([pa.array(own[c]) if c in own else table.column(c) for c in table.column_names], table.column_names)

        done = stored(now.groupBy("grp").applyInArrow(run, now.schema))
        out = out.unionByName(done.where("not handed_on").select(*names, "sequence_id", "offset"))
        if ends:
            break
        groups = -(-groups // FAN)
        now = done.where("handed_on").withColumn("grp", F.pmod("grp", F.lit(groups)))
    return out.drop("_row")


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the ids of each sequence in order, and the documents that it holds, from packed pieces that have ids."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # of at most `capacity` pieces
    return packed.groupBy("sequence_id").agg(held.alias("held")).select("sequence_id", F.flatten("held.ids").alias("ids"), F.col("held.doc_id").alias("doc_ids"))


def packed_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Where each piece of each document goes; ids only by their checksum."""
    return pack(pieces(docs, vocabulary, with_ids=False).drop("ids"))
