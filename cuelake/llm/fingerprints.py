"""MinHash fingerprints of documents, and near copies found by bands of them.

A fingerprint is the minimum of each of PERMUTATIONS universal hash permutations
over the document's five-word shingles, all in numpy over the Arrow buffer. The
share of equal minima estimates the Jaccard similarity of the shingle sets.

Null texts count as empty. An empty document has a fingerprint of its own, which
is like that of other empty documents only. A document of one to four words has
one shingle. Equal texts have equal fingerprints. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K
from cuelake.llm.store import stored

WORDS, PERMUTATIONS = 5, 128
#: Bands and rows of a band: a pair with Jaccard 0.8 shares none of them with probability 2e-7.
BANDS, ROWS = 32, 4
#: How far an estimate may lie below the threshold, and about the classes of a block of a bucket.
SLACK, CELL = 0.17, 1024
#: Bytes of a block of documents, and the most blocks; beyond that blocks grow, to 1 GB of a task's sort at 100 TB.
BLOCK_BYTES, MOST_BLOCKS = 8 << 20, 100_000
SLICE = 1 << 20
#: A table of at most so many ids is broadcast.
BROADCAST_ROWS = 1_000_000

EDITED_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def signatures(raw: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> np.ndarray:
    """PERMUTATIONS minima of each text, of which the low 16 bits are kept. A text longer than a slice goes through in pieces."""
    parts = []
    for a, b in K.slices(offsets, SLICE):
        own = raw[offsets[a] : offsets[b]]
        if len(own) > SLICE:
            low = np.full((1, PERMUTATIONS), 0xFFFFFFFF, np.uint32)
            for shingles in K.pieced_shingles(own, k=k, piece=SLICE):
                low = np.minimum(low, _PERMUTE.signatures(shingles, np.array([0, len(shingles)])))
        else:
            hashes, first = K.word_hashes(own, offsets[a : b + 1] - offsets[a])
            low = _PERMUTE.signatures(*K.shingle_hashes(hashes, first, k))
        parts.append((low & np.uint32(0xFFFF)).astype(np.uint16))
    return np.concatenate(parts) if parts else np.zeros((0, PERMUTATIONS), np.uint16)


_PERMUTE = K.Permutations(PERMUTATIONS)


def text_of(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u2").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of signatures."""
    return (a == b).mean(axis=-1)


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, signature binary): PERMUTATIONS 16-bit minima for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in signatures(*K.strings(b.column(1)))], pa.binary())], ["doc_id", "signature"])

    return docs.select(key, text).mapInArrow(run, "doc_id long, signature binary")


def _sets(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """(id, class, set of shingles), or its signature, for rows (id, text). A class is the digest of the set; null without words."""
    for b in batches:
        raw, offsets = K.strings(b.column(1))
        cls, own, marks = [], [], []
        for lo, hi in K.slices(offsets, SLICE):
            part = raw[offsets[lo] : offsets[hi]]
            if len(part) > 2 * SLICE:  # one long text
                made = [np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(x) for x in K.pieced_shingles(part, k=WORDS, piece=SLICE))]))]
            else:
                hashes, first = K.word_hashes(part, offsets[lo : hi + 1] - offsets[lo])
                shingles, where = K.shingle_hashes(hashes, first, WORDS)
                made = [np.unique(shingles[where[t] : where[t + 1]]) for t in range(hi - lo)]
            cls += [hashlib.md5(x.tobytes()).digest() if len(x) else None for x in made]
            if whole:
                own += [x.view(np.int64) for x in made]
            else:
                low = _PERMUTE.signatures(np.concatenate(made), np.concatenate([[0], np.cumsum([len(x) for x in made])]))
                marks += [m.tobytes() for m in (low & np.uint32(0xFFFF)).astype("<u2")]
        last = pa.array(own, pa.list_(pa.int64())) if whole else pa.array(marks, pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(cls, pa.binary()), last], ["id", "class", "shingles" if whole else "signature"])


def _sketched(docs: DataFrame) -> DataFrame:
    """(id, class, signature, h) for each row of docs; h is the hash of its text, as rows of one id may have different texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for made in _sets(iter([b]), False):
                yield pa.RecordBatch.from_arrays([*made.columns, b.column(2)], ["id", "class", "signature", "h"])

    return stored(docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(K.releasing(run), "id long, class binary, signature binary, h long"))


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, jaccard), a < b: links between documents of at least `threshold`, found by equal bands and verified on whole shingle sets.

    Documents with equal sets are one class, named by its smallest doc_id; links
    are between classes, and `classes` says who is in them. A large group has as many
    rows as pairs; `linked_rows` gives numbers of links instead. Every two classes that
    share a band meet: a bucket of any size is cut in blocks of about CELL classes,
    and each pair of blocks is a cell of its own, so that no task holds more than
    two blocks. A cell compares signatures first and names the classes that have one
    that looks alike (SLACK below the threshold is 4.8 standard deviations) and shares
    no earlier band. Their shingle sets are brought to the cell, each once, and all
    intersections in it are counted; a pair belongs to the cell of its first band.
    """

    def pairs(ids: np.ndarray, i: int, js: np.ndarray, share: np.ndarray) -> pa.RecordBatch:
        one, two = np.minimum(ids[i], ids[js]), np.maximum(ids[i], ids[js])
        return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(share)], ["a", "b", "jaccard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, links in _cells(batches, threshold):
            yield from (pairs(ids, *link) for link in links)

    return _seated(docs, _sketched(docs), threshold, "id").mapInArrow(K.releasing(run), "a long, b long, jaccard double")


def _seated(docs: DataFrame, known: DataFrame, threshold: float, named: str) -> DataFrame:
    """(cell, band, second, id, signature, shingles) in the order of cells: the classes that have one that looks alike, in the cells where they meet it. id is the class's smallest doc_id or, with `named` "key", the hash of the class, which differs also where rows of one id have different texts."""
    found = known.where("class is not null and id is not null").groupBy("class").agg(F.min("id").alias("id"), F.min_by("signature", "id").alias("signature"))
    found = stored(found.withColumn("key", F.xxhash64("class")))
    seats = stored(_alike(found.select(F.col("key").alias("id"), "signature"), threshold)).withColumnRenamed("id", "key")
    members = found.join(seats.select("key").distinct(), "key", "left_semi")
    ids = members.select("id").distinct()
    few = ids.count() <= BROADCAST_ROWS
    own = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id", "left_semi")
    own = own.mapInArrow(K.releasing(lambda batches: _sets(batches, True)), "id long, class binary, shingles array<long>")
    own = own.join(members, ["id", "class"]).dropDuplicates(["key"]).drop("class")
    return seats.join(own, "key").select("cell", "band", "second", F.col(named).alias("id"), "signature", "shingles").repartition("cell").sortWithinPartitions("cell", "second", "id")


def _cells(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[tuple[np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]]:
    """(ids, links) of each cell; links has (i, js, jaccard): a class and the later ones that it is linked with there."""
    now, rows = None, ([], [], [], [])
    for b in batches:
        sets, marks = b.column("shingles"), b.column("signature").to_pylist()
        for k, (cell, band, second, key) in enumerate(zip(*(b.column(c).to_pylist() for c in ("cell", "band", "second", "id")), strict=True)):
            if cell != now:
                if len(rows[0]) > 1:
                    yield np.array(rows[0], np.int64), _links(now_band, *rows[1:], threshold)
                now, now_band, rows = cell, band, ([], [], [], [])
            for column, value in zip(rows, (key, second, marks[k], sets[k].values.to_numpy().view(np.uint64).copy()), strict=True):
                column.append(value)
    if len(rows[0]) > 1:
        yield np.array(rows[0], np.int64), _links(now_band, *rows[1:], threshold)


def _links(band: int, second: list[int], marks: list[bytes], sets: list[np.ndarray], threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A cell of one block holds it against itself, one of two the first against the second."""
    sig, size = np.frombuffer(b"".join(marks), "<u2").reshape(len(sets), BANDS, ROWS), np.array([len(s) for s in sets])
    half = len(sets) - sum(second)
    if not half:
        return
    alone = half == len(sets)
    for lo, hi, after, met in K.intersections(sets, half=0 if alone else half):
        share = met / (size[lo:hi, None] + size[None, after:] - met.astype(np.float64))
        for i in range(lo, hi):
            js = after + np.flatnonzero(share[i - lo] >= threshold)
            js = js[js > i]
            js = js[~(sig[js, :band] == sig[i, :band]).all(axis=2).any(axis=1)] if band else js
            js = js[(sig[js, band] == sig[i, band]).all(axis=1)]
            if len(js):
                yield i, js, share[i - lo, js - after]


def linked_rows(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, n_links) for each row of docs: the smallest doc_id with the same set of shingles, and how many other sets have at least `threshold` of similarity. Rows without words are a class of their own id and have no links; rows without an id have neither. No pair is written: a cell gives each of its classes a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, links in _cells(batches, threshold):
            n = np.zeros(len(ids), np.int64)
            for i, js, _ in links:
                n[i] += len(js)
                n[js] += 1
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["key", "n"])

    known = _sketched(docs)
    ends = _seated(docs, known, threshold, "key").mapInArrow(K.releasing(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n_links"))
    known = known.where("class is not null and id is not null").withColumn("key", F.xxhash64("class"))
    named = known.groupBy("key").agg(F.min("id").alias("class_id")).join(ends, "key", "left")
    # by id and text, so that each row of a repeated id has its own class; equal texts have one
    own = known.select("id", "h", "key").distinct().join(named, "key").select("id", "h", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    met = docs.select("doc_id", F.xxhash64("text").alias("_h")).join(own, (F.col("doc_id") == F.col("id")) & (F.col("_h") == F.col("h")), "left")
    return met.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def classes(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, class_id): the class of each row that has words and a doc_id, as `near_pairs` names it."""
    known = _sketched(docs) if known is None else known
    known = known.where("class is not null and id is not null").select(F.col("id").alias("doc_id"), "class")
    return known.join(known.groupBy("class").agg(F.min("doc_id").alias("class_id")), "class").select("doc_id", "class_id")


def _alike(rows: DataFrame, threshold: float) -> DataFrame:
    """(cell, band, second, id): rows (id, signature) that have one that looks alike in a cell and shares no earlier band; second tells the blocks of a cell of two apart."""
    least = int(np.ceil((threshold - SLACK) * PERMUTATIONS))
    width = 2 * ROWS
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    keyed = rows.select("id", "signature", band).select("id", "band", F.xxhash64("band", F.expr(f"substring(signature, band * {width} + 1, {width})")).alias("bucket"))
    buckets = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / CELL).cast("int")).drop("n")
    # signatures go only to buckets of several
    met = keyed.join(buckets, "bucket").join(rows, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.select("band", "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("second"), "id", "signature")
    order = ["band", "bucket", "p", "q"]
    dealt = cells.repartition(*order).sortWithinPartitions(*order, "second", "id")

    def members(name: str, second: list[int], ids: list[int], marks: list[bytes], band: int, one: bool) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(marks), "<u2").reshape(len(ids), -1)
        half = len(ids) - sum(second)  # of a cell of two blocks, rows of the first come first
        alike = np.zeros(len(ids), bool)
        for i in range(half):
            rest = np.arange(i + 1 if one else half, len(ids))
            same = sig[rest] == sig[i]
            ok = np.flatnonzero(same.sum(axis=1) >= least)
            ok = ok[~same[ok].reshape(-1, BANDS, ROWS)[:, :band].all(axis=2).any(axis=1)]
            alike[rest[ok]] = True
            alike[i] |= len(ok) > 0
        own = np.flatnonzero(alike)
        return pa.RecordBatch.from_arrays([pa.array([name] * len(own), pa.string()), pa.array([band] * len(own), pa.int32()), pa.array(np.array(second, np.int32)[own]), pa.array(np.array(ids, np.int64)[own])], ["cell", "band", "second", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, second, ids, marks = None, [], [], []

        def out() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                yield members(":".join(map(str, now)), second, ids, marks, now[0], now[2] == now[3])

        for b in batches:
            for *key, side, key_id, mark in zip(*(b.column(c).to_pylist() for c in (*order, "second", "id", "signature")), strict=True):
                if key != now:
                    yield from out()
                    now, second, ids, marks = key, [], [], []
                second.append(side)
                ids.append(key_id)
                marks.append(mark)
        yield from out()

    return dealt.mapInArrow(K.releasing(run), "cell string, band int, second int, id long")


def _blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """docs in blocks of neighbouring ids, dealt by block. Each block also has the first document, in descending order, of the block that follows it."""
    from pyspark.ml.feature import Bucketizer  # here, as workers need none of it

    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    count = max(1, min(MOST_BLOCKS, (size or 0) // BLOCK_BYTES, n))
    cuts = docs.select(F.col("doc_id").cast("double").alias("_d")).approxQuantile("_d", [i / count for i in range(1, count)], 0.1 / count) if count > 1 else []
    inner = sorted({float(c) for c in cuts})
    keyed = docs.withColumn("_d", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    splits = [float("-inf"), *inner, float("inf")]
    if len(splits) > 2:
        keyed = Bucketizer(splits=splits, inputCol="_d", outputCol="_block").transform(keyed).withColumn("_block", F.col("_block").cast("int"))
    else:
        keyed = keyed.withColumn("_block", F.lit(0))
    heads = sorted(keyed.groupBy("_block").agg(F.max("doc_id").alias("h")).collect())  # at most MOST_BLOCKS rows
    lent = F.lit(None).cast("int")
    for k, (block, head) in enumerate(heads):
        after = heads[(k + 1) % len(heads)][0]
        lent = F.when((F.col("_block") == block) & F.col("doc_id").eqNullSafe(F.lit(head)), F.lit(after)).otherwise(lent) if len(heads) <= 64 else lent
    if len(heads) > 64:
        table = docs.sparkSession.createDataFrame([(b, h, heads[(k + 1) % len(heads)][0]) for k, (b, h) in enumerate(heads)], "_block int, _head long, _after int")
        keyed = keyed.join(F.broadcast(table), "_block", "left")  # at most MOST_BLOCKS rows
        lent = F.when(F.col("doc_id").eqNullSafe(F.col("_head")), F.col("_after"))
    both = F.when(lent.isNull(), F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("lent")))).otherwise(F.array(F.struct(F.col("_block").alias("b"), F.lit(0).alias("lent")), F.struct(lent.alias("b"), F.lit(1).alias("lent"))))
    spread = keyed.select("doc_id", "text", F.explode(both).alias("_to")).select("doc_id", "text", F.col("_to.b").alias("_block"), F.col("_to.lent").alias("_lent"))
    return spread, max(1, len(heads))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document.

    The next document is the one with the next smaller doc_id, after the last the
    first; null ids come last; rows of equal ids go by text, nulls first. In the
    edited text the last third of the code points, rounded down, is replaced by
    as many, or all, of the next document's first.
    """
    spread, n = _blocks(docs.select("doc_id", "text"))
    dealt = spread.repartition(n, "_block").sortWithinPartitions("_block", "_lent", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            raw, offsets = K.strings(b.column("text"))
            ids, blocks, lent = b.column("doc_id"), b.column("_block").to_numpy(), b.column("_lent").to_numpy()
            for lo, hi in K.slices(offsets, SLICE):
                own = raw[offsets[lo] : offsets[hi]]
                rows = Rows(ids.slice(lo, hi - lo), blocks[lo:hi], lent[lo:hi], [own[x:y] for x, y in zip(offsets[lo:hi] - offsets[lo], offsets[lo + 1 : hi + 1] - offsets[lo], strict=True)], signatures(own, offsets[lo : hi + 1] - offsets[lo]))
                met = rows if last is None else last + rows
                if out := _edited(met):
                    yield out
                last = met.last()

    return dealt.mapInArrow(K.releasing(run), EDITED_SCHEMA)


@dataclass
class Rows:
    """Rows of a block in order. Texts are views of the batch's bytes."""

    ids: pa.Array
    block: np.ndarray
    lent: np.ndarray
    texts: list[np.ndarray]
    marks: np.ndarray

    def __add__(self, more: Rows) -> Rows:
        return Rows(pa.concat_arrays([self.ids, more.ids]), *(np.concatenate(x) for x in ((self.block, more.block), (self.lent, more.lent))), self.texts + more.texts, np.concatenate([self.marks, more.marks]))

    def last(self) -> Rows:
        """The last row, with a text of its own, as the batch goes."""
        return Rows(self.ids.slice(len(self.ids) - 1), self.block[-1:], self.lent[-1:], [self.texts[-1].copy()], self.marks[-1:])


def _edited(rows: Rows) -> pa.RecordBatch | None:
    """Answers for every row that is followed by one of its block. A block ends with lent rows: the first of them follows its last own row, and only a block's own rows are answered for."""
    which = np.flatnonzero((rows.lent[:-1] == 0) & (rows.block[:-1] == rows.block[1:]))
    if not len(which):
        return None
    n_chars, digests, near, marks = [], [], [], []
    part, size = [], 0

    def compared() -> None:
        nonlocal part, size
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in part], dtype=np.int64)])
        changed = signatures(np.concatenate(part), offsets)
        own = which[len(digests) - len(part) : len(digests)]
        near.append(likeness(rows.marks[own], changed))
        marks.extend(map(text_of, changed))
        part, size = [], 0

    for t in which.tolist():
        own, after = rows.texts[t], rows.texts[t + 1]
        points = K.code_points(own)
        cut = len(points) // 3
        ahead = K.code_points(after[: 4 * cut + 4])
        tail = after[: ahead[cut]] if len(ahead) > cut else after
        text = np.concatenate([own[: points[len(points) - cut]], tail]) if cut else own
        n_chars.append(len(points))
        digests.append(hashlib.sha256(text).hexdigest())
        part.append(text)
        size += len(text)
        if size >= SLICE:
            compared()
    if part:
        compared()
    return pa.RecordBatch.from_arrays(
        [
            rows.ids.take(pa.array(which)).cast(pa.int64()),
            pa.array(n_chars, pa.int64()),
            pa.array(digests),
            pa.array([text_of(s) for s in rows.marks[which]]),
            pa.array(marks),
            pa.array(np.concatenate(near)),
            pa.array(likeness(rows.marks[which], rows.marks[which + 1])),
        ],
        [c.split()[0] for c in EDITED_SCHEMA.split(", ")],
    )
