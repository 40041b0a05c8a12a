"""Near copies by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

1. Each text becomes its set of distinct five-word shingles (A-Z lowered), a class
   (equal sets) and a signature of 128 minima. From here on a class is one row, so
   any number of exact copies is one document.
2. Each of TREES trees sorts all classes by its own eight minima, all trees in one
   range-partitioned sort. Neighbours with a long common prefix are candidates: a
   region is a run of rows with the same first minima (least_depth). A region of more
   than REGION rows is taken one minimum deeper, and so on; rows that share all
   eight go by overlapping windows, and a row is always held against the next one.
   In a region rows are compared by signature, and those that look alike (BELOW,
   far below the threshold) are tied together by a spanning forest: n rows give at
   most n - 1 candidate links, never all pairs.
3. What the candidate links connect is a neighbourhood, small but for real groups of
   copies. Its members' texts are brought together, and all pairs of sets in it are
   counted exactly, by blocks; what is left are links with
   100 * intersection >= percent * union, 85 by default. In a neighbourhood beyond GROUP_DOCS or
   GROUP_SHINGLES overlapping runs of that size, along GROUP_TREES of the sorted
   orders, merge the obvious members first. Then it is cut in blocks of half that
   size, and every two blocks are counted exactly in a cell of their own, but for
   blocks of members that are merged already and blocks whose sizes are too far
   apart for any link. So large neighbourhoods are as exact as small ones; the work
   for what the runs do not merge grows with the square of the neighbourhood.

A row in steps 2 and 3 is lost only if a pair at the threshold meets in no tree. At
0.85 regions begin at depth four, (1 - 0.85**4)**16, under one in 100,000; at 0.80 at
depth three, (1 - 0.8**3)**16, about one in 97,000. Lower thresholds begin less deep.
That holds for regions of up to REGION rows, also where the deal to tasks cuts them, as
the rows next to a cut meet once more. In larger regions a pair of just the threshold
may need up to DEPTH equal minima, (1 - 0.85**8)**16 = 0.6 %, if nothing else connects
it: there rows also meet in windows of REGION rows, each with its neighbours, and in
groups of so many near copies links by way of third rows are plenty.

Null texts and texts without words have an empty set: linked with nothing, kept. Rows
with a null doc_id are compared like others; their component is the smallest id in
it, or null. Repeated rows are in one class. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K
from cuelake.llm.store import components, stored

WORDS = 5
PERCENT = 85
TREES, DEPTH = 16, 8
#: The most that a pair at the threshold may meet in no tree; regions begin as deep as that allows.
MISSED = 1.1e-5
REGION = 1024
#: Minima that are compared in a region, one byte of each, and how many standard deviations below the threshold the least share of equal ones is.
COMPARED, BELOW = 64, 4.7
#: Rows of a sorted order that a task holds.
HELD = 1 << 16
GROUP_DOCS, GROUP_SHINGLES, GROUP_TREES = 16_384, 6_000_000, 6
#: A table of at most so many rows of three numbers is broadcast.
BROADCAST_ROWS = 1_000_000
SLICE = 1 << 20

_PERMUTE = K.Permutations(TREES * DEPTH, seed=9)


def least_depth(percent: int) -> int:
    """How many equal first minima rows of a region have: 4 at 85 %, 3 at 80 %."""
    return max([1, *(d for d in range(1, DEPTH + 1) if (1 - (percent / 100) ** d) ** TREES <= MISSED)])


def least_equal(percent: int) -> int:
    """Of COMPARED minima, how many are equal at least in rows that look alike: 41 at 85 %, 37 at 80 %."""
    share = percent / 100
    return max(1, math.ceil(COMPARED * share - BELOW * math.sqrt(COMPARED * share * (1 - share))))


def _long(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, signed: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """(sorted distinct shingle hashes, signature) of each text."""
    for a, b in K.slices(offsets, SLICE):
        if offsets[b] - offsets[a] > 2 * SLICE:  # one long text: in pieces, whose sets are joined
            parts, mark = [np.zeros(0, np.uint64)], np.full(_PERMUTE.a.shape, 0xFFFFFFFF, np.uint32)
            for shingles in K.pieced_shingles(raw[offsets[a] : offsets[b]], lower=True, k=WORDS, piece=SLICE):
                parts.append(np.unique(shingles))
                if signed:
                    mark = np.minimum(mark, _PERMUTE.signatures(parts[-1], np.array([0, len(parts[-1])]))[0])
            yield np.unique(np.concatenate(parts)), mark if signed else None
            continue
        hashes, first = K.word_hashes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        shingles, where = K.shingle_hashes(hashes, first, WORDS)
        marks = _PERMUTE.signatures(shingles, where) if signed else [None] * (b - a)
        for t in range(b - a):
            yield np.unique(shingles[where[t] : where[t + 1]]), marks[t]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, cls, signature, h) for each row; cls is null for an empty set, h is the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, marks = [], [], []
            for own, mark in shingle_sets(*K.strings(b.column(1))):
                n.append(len(own))
                cls.append(_long(hashlib.md5(own.tobytes()).digest()) if len(own) else None)
                marks.append((mark & np.uint32(0xFFFF)).astype(">u2").tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(marks, pa.binary()), b.column(2)], ["doc_id", "n", "cls", "signature", "h"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(K.releasing(run), "doc_id long, n long, cls long, signature binary, h long")


def _classed(docs: DataFrame) -> DataFrame:
    """(cls, text) of each class of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = [_long(hashlib.md5(own.tobytes()).digest()) for own, _ in shingle_sets(*K.strings(b.column(0)), signed=False)]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), b.column(0)], ["cls", "text"])

    return docs.select("text").mapInArrow(K.releasing(run), "cls long, text string").dropDuplicates(["cls"])


def tree_rows(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """(place, cls, compared): the place of each class in each tree's order; places of all trees sort together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint8).reshape(len(b), TREES, 2 * DEPTH)
            few = pa.array([m.tobytes() for m in np.ascontiguousarray(marks.reshape(len(b), -1)[:, 1::2][:, ::2])], pa.binary())
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array([bytes([t]) + m.tobytes() for m in marks[:, t]], pa.binary()), b.column("cls"), few], ["place", "cls", "compared"])

    return classes.select("cls", "signature").mapInArrow(K.releasing(run), "place binary, cls long, compared binary")


def regions(places: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Runs of sorted rows to compare: as deep as it takes to have at most REGION rows."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(places), least)]
    while todo:
        lo, hi, depth = todo.pop()
        part = places[lo:hi, : 1 + 2 * depth]
        cuts = np.flatnonzero((part[1:] != part[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), hi - lo]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a < 2:
                continue
            if b - a <= REGION:
                out.append((lo + a, lo + b))
            elif depth < DEPTH:
                todo.append((lo + a, lo + b, depth + 1))
                out += _windows(lo + a, lo + b, 2)
            else:
                out += _windows(lo + a, lo + b, REGION)
    return out


def _windows(lo: int, hi: int, size: int) -> list[tuple[int, int]]:
    return [(a, min(a + size, hi)) for a in range(lo, max(lo + 1, hi - size // 2), max(1, size // 2))]


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of 0..n-1 is connected with by the edges."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = np.minimum(after, after[after])
        while not np.array_equal(again := after[after], after):
            after = again
        if np.array_equal(after, label):
            return label
        label = after


def _alike(marks: np.ndarray, runs: list[tuple[int, int]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in the runs with enough equal minima."""
    found_a, found_b = [], []
    by_size: dict[int, list[int]] = {}
    for lo, hi in runs:
        by_size.setdefault(hi - lo, []).append(lo)
    for m, starts in by_size.items():
        if m <= 24:
            i, j = np.triu_indices(m, 1)
            for k in range(0, len(starts), max(1, (1 << 20) // len(i))):
                base = np.array(starts[k : k + max(1, (1 << 20) // len(i))])[:, None]
                a, b = (base + i).ravel(), (base + j).ravel()
                for c in range(0, len(a), 1 << 16):
                    p, q = a[c : c + (1 << 16)], b[c : c + (1 << 16)]
                    ok = (marks[p] == marks[q]).sum(axis=1) >= least
                    found_a.append(p[ok])
                    found_b.append(q[ok])
        else:
            for lo in starts:
                own = marks[lo : lo + m]
                for i in range(m - 1):
                    ok = np.flatnonzero((own[i + 1 :] == own[i]).sum(axis=1) >= least)
                    found_a.append(np.full(len(ok), lo + i))
                    found_b.append(lo + i + 1 + ok)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def candidate_links(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): a spanning forest of what looks alike in each region of the sorted orders."""
    least, equal = least_depth(percent), least_equal(percent)

    def links(places: list[bytes], cls: list[int], marks: list[bytes]) -> pa.RecordBatch | None:
        if len(cls) < 2:
            return None
        where = np.frombuffer(b"".join(places), np.uint8).reshape(len(cls), -1)
        runs = regions(where, least)
        if not runs:
            return None
        a, b = _alike(np.frombuffer(b"".join(marks), np.uint8).reshape(len(cls), -1), runs, equal)
        label = spanning(len(cls), a, b)
        own = np.array(cls, np.int64)
        tied = np.flatnonzero((label != np.arange(len(cls))) & (own != own[label]))
        return pa.RecordBatch.from_arrays([pa.array(own[tied]), pa.array(own[label[tied]])], ["a", "b"]) if len(tied) else None

    width = 1 + 2 * least
    names = ("place", "cls", "compared")

    def sorted_rows(batches: Iterator[pa.RecordBatch], at_border: bool) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        first: tuple[list, list, list] = ([], [], [])
        for b in batches:
            new = [b.column(name).to_pylist() for name in names]
            if at_border and new[0] and len(first[0]) < REGION and (not first[0] or new[0][0].startswith(first[0][0][:width])):
                head = (first[0] or new[0])[0][:width]
                upto = next((k for k, p in enumerate(new[0]) if not p.startswith(head)), len(new[0]))
                for mine, x in zip(first, new, strict=True):
                    mine += x[: min(upto, REGION - len(mine))]
            for mine, x in zip(held, new, strict=True):
                mine += x
            if len(held[0]) >= HELD:
                upto = len(held[0])
                head = held[0][-1][:width]
                cut = upto
                while cut and held[0][cut - 1].startswith(head):
                    cut -= 1
                done, keep = (cut, cut) if cut else (upto, max(0, upto - REGION))
                if (out := links(*(x[:done] for x in held))) is not None:
                    yield with_border(out)
                held = tuple(x[keep:] for x in held)
        if (out := links(*held)) is not None:
            yield with_border(out)
        if at_border and held[0]:
            head = held[0][-1][:width]
            begin = max(len(held[0]) - REGION, next(k for k, p in enumerate(held[0]) if p.startswith(head)))
            for own in (first, tuple(x[begin:] for x in held)):
                none = pa.nulls(len(own[0]), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array([p[:width] for p in own[0]], pa.binary()), pa.array(own[0], pa.binary()), pa.array(own[1], pa.int64()), pa.array(own[2], pa.binary())], ["a", "b", "region", *names])

    def with_border(out: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(len(out), pa.binary())
        return pa.RecordBatch.from_arrays([*out.columns, none, none, pa.nulls(len(out), pa.int64()), none], ["a", "b", "region", *names])

    schema = "a long, b long, region binary, place binary, cls long, compared binary"
    n = max(1, rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(n, "place").sortWithinPartitions("place")
    found = stored(dealt.mapInArrow(K.releasing(lambda batches: sorted_rows(batches, True)), schema))
    # a region that the deal has cut: its rows next to each cut meet again
    cut = found.where("region is not null").select("region", *names)
    met = cut.repartition("region").sortWithinPartitions("place").select(*names).mapInArrow(K.releasing(lambda batches: sorted_rows(batches, False)), schema)
    return found.where("region is null").select("a", "b").union(met.select("a", "b"))


def linked(sets: list[np.ndarray], percent: int = PERCENT, block: int = 512, half: int = 0) -> np.ndarray:
    """For each set the first one that links of exact Jaccard connect it with. With `half` only the first so many sets are held against only the others."""
    m = len(sets)
    if m < 2:
        return np.zeros(m, np.int64)
    size = np.array([len(s) for s in sets])
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * both >= percent * (size.sum() - both) else 1])
    label = np.arange(m)
    for lo, hi, after, met in K.intersections(sets, block, half):
        union = size[lo:hi, None] + size[None, after:] - met
        i, j = np.nonzero(100 * met >= percent * union)
        label = spanning(m, np.concatenate([i + lo, np.arange(m)]), np.concatenate([j + after, label]))
    return label


def confirm(rows: DataFrame, group: str, percent: int = PERCENT) -> DataFrame:
    """(a, b): each class and the first of its group that exact links connect it with, for rows (group, cls, text). Where rows have a `side`, those of side 0 are held against those of side 1 only, if there are any."""
    sided = "side" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cls, sets, half = None, [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if cls:
                label = linked(sets, percent, half=half if half < len(cls) else 0)
                own = np.array(cls, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(own[label])], ["a", "b"])

        for b in batches:
            keys, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            sides = b.column(3).to_pylist() if sided else [1] * len(keys)
            for key, c, side, (own, _) in zip(keys, ids, sides, shingle_sets(*K.strings(b.column(2)), signed=False), strict=True):
                if key != now:
                    yield from out()
                    now, cls, sets, half = key, [], [], 0
                if (not cls or c != cls[-1]) and _long(hashlib.md5(own.tobytes()).digest()) == c:
                    cls.append(c)
                    sets.append(own)
                    half += side == 0
        yield from out()

    more = ["side"] if sided else []
    return rows.repartition(group).sortWithinPartitions(group, *more, "cls").select(group, "cls", "text", *more).mapInArrow(K.releasing(run), "a long, b long")


def near_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs; links are of at least `percent` % Jaccard similarity."""
    known, named = _named(docs, percent)
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = stored(named.join(least, "root").select("cls", "component_id"))
    met = known.select("doc_id", "n", "cls").join(found, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def survivors(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, h) of the rows of which one stays of each component: the smallest doc_id, null after all, then the smallest hash of the text. Rows with an empty set all stay, equal ones once."""
    known, named = _named(docs, percent)
    least = stored(named.groupBy("root").agg(F.min("first").alias("first")))
    return least.select("first.doc_id", "first.h").union(known.where("cls is null").select("doc_id", "h").distinct())


def _named(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and (cls, rep, first, root) of their classes: the smallest doc_id, the row that stays if the class does, the component."""
    known = stored(sketches(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("first")
    classes = stored(known.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("signature").alias("signature"), first))
    near = components(candidate_links(tree_rows(classes), percent))
    members = classes.join(near, classes["cls"] == near["node"]).select("cls", "rep", "n", "root", "signature")
    sized = members.groupBy("root").agg(F.count("*").alias("_docs"), F.sum("n").alias("_shingles"))
    members = stored(members.join(sized, "root").withColumn("large", (F.col("_docs") > GROUP_DOCS) | (F.col("_shingles") > GROUP_SHINGLES)).select("cls", "rep", "root", "large", F.when(F.col("large"), F.col("signature")).alias("signature"), F.when(F.col("large"), F.col("n")).alias("n")))
    count, large, shingles, unnamed = members.agg(F.count("*"), F.count(F.when(F.col("large"), 1)), F.sum("n"), F.count(F.when(F.col("rep").isNull(), 1))).first()
    texts = docs.select(F.col("doc_id").alias("rep"), "text")

    def with_text(keys: DataFrame, few: bool = count <= BROADCAST_ROWS) -> DataFrame:
        own = F.broadcast(keys) if few else keys
        met = texts.join(own, "rep")
        if unnamed:  # classes of which no row has an id are met by their sets
            met = met.unionByName(_classed(docs.where("doc_id is null")).join(keys.where("rep is null").drop("rep"), "cls"), allowMissingColumns=True)
        return met

    links = confirm(with_text(members.where("not large").select("rep", "cls", "root")), "root", percent)
    if large:
        own = members.where("large")
        merged = stored(confirm(with_text(_dealt(own)), "run", percent).where("a <> b"))
        cells = _cells(own, components(merged), max(large / GROUP_DOCS, shingles / GROUP_SHINGLES), percent)
        links = links.union(merged).union(confirm(with_text(cells, few=False), "cell", percent))
        tied = components(links.where("a <> b"))
        tied = tied.select(F.col("node").alias("a"), F.col("root").alias("b"))
    else:
        tied = links
    tied = stored(tied)
    return known, classes.join(tied, classes["cls"] == tied["a"], "left").select("cls", "rep", "first", F.coalesce("b", "cls").alias("root"))


def _dealt(members: DataFrame) -> DataFrame:
    """(rep, cls, run): the members of each neighbourhood that is too large, in overlapping runs along some sorted orders."""
    rows = tree_rows(members, GROUP_TREES).drop("compared").join(members.select("cls", "rep", "root", "n"), "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        task, number, docs, shingles, now = pyspark.TaskContext.get().partitionId(), 0, 0, 0, None
        for b in batches:
            root, place, n = (b.column(c).to_pylist() for c in ("root", "place", "n"))
            name = []
            for key, size in zip(zip(root, [p[0] for p in place], strict=True), n, strict=True):
                if key != now or docs >= GROUP_DOCS // 2 or shingles >= GROUP_SHINGLES // 2:
                    number += 1 + (key != now)
                    docs, shingles, now = 0, 0, key
                docs, shingles = docs + 1, shingles + size
                name.append((task << 32) + number)
            for back in (0, 1):
                yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("cls"), pa.array([x - back for x in name], pa.int64())], ["rep", "cls", "run"])

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "root", "place").sortWithinPartitions("root", "place").mapInArrow(K.releasing(run), "rep long, cls long, run long")


def _cells(members: DataFrame, merged: DataFrame, groups: float, percent: int) -> DataFrame:
    """(rep, cls, cell, side): the members of each neighbourhood that is too large, in blocks of which every two that a link can connect meet in a cell; merged has (node, root) of members that are known to be connected."""
    known = members.select("rep", "cls", "root", "n").join(merged.select(F.col("node").alias("cls"), F.col("root").alias("_tied")), "cls", "left")
    # a merged component that fills a good part of a block has blocks of its own
    wide = known.where("_tied is not null").groupBy("_tied").agg(F.count("*").alias("_docs"), F.sum("n").alias("_shingles")).where((F.col("_docs") >= GROUP_DOCS // 8) | (F.col("_shingles") >= GROUP_SHINGLES // 8)).select("_tied", F.col("_tied").alias("whole"))
    order = ["root", "whole", "n", "cls"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        task, number, docs, shingles, now = pyspark.TaskContext.get().partitionId(), 0, 0, 0, None
        for b in batches:
            block = []
            for *key, size in zip(*(b.column(c).to_pylist() for c in ("root", "whole", "n")), strict=True):
                if key != now or docs >= GROUP_DOCS // 2 or docs and shingles + size > GROUP_SHINGLES // 2:
                    number, docs, shingles, now = number + 1, 0, 0, key
                docs, shingles = docs + 1, shingles + size
                block.append((task << 32) + number)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("rep", "cls", "root", "whole", "n")), pa.array(block, pa.int64())], ["rep", "cls", "root", "whole", "n", "block"])

    # few partitions, as each begins a block; a row is five numbers
    dealt = known.join(wide, "_tied", "left").repartitionByRange(max(1, int(groups)), *order).sortWithinPartitions(*order)
    dealt = stored(dealt.select("rep", "cls", "root", "whole", "n").mapInArrow(K.releasing(run), "rep long, cls long, root long, whole long, n long, block long"))
    blocks = dealt.groupBy("root", "whole", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one, two = (blocks.select("root", *(F.col(c).alias(f"{c}_{k}") for c in ("whole", "block", "low", "high"))) for k in (1, 2))
    met = one.join(two, "root").where("block_1 <= block_2 and not coalesce(whole_1 = whole_2, false)")
    met = met.where((100 * F.col("high_1") >= percent * F.col("low_2")) & (100 * F.col("high_2") >= percent * F.col("low_1")))
    cell = F.concat_ws(":", "block_1", "block_2").alias("cell")
    sides = F.array(F.struct(F.col("block_1").alias("block"), F.lit(0).alias("side")), F.struct(F.col("block_2").alias("block"), F.lit(1).alias("side")))
    sides = F.when(F.col("block_1") == F.col("block_2"), F.slice(sides, 1, 1)).otherwise(sides)
    seats = met.select(cell, F.explode(sides).alias("_s")).select("cell", "_s.block", "_s.side")
    return dealt.join(seats, "block").select("rep", "cls", "cell", "side")
