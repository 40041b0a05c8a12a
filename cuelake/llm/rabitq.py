"""Approximate nearest neighbours by randomly rotated one-bit codes, in inverted lists.

Index. Centres are fitted on the driver by a few rounds of k-means over a bounded
sample (SAMPLE_ROWS, the rows that hash lowest). Every row is listed under its nearest
centre; a list of more than BLOCK rows is split in blocks of about that size. What a
vector has beyond its centre, the residual, is padded with zeros to CODE_BITS
coordinates, turned by one random rotation from a fixed seed, and kept as the signs of
the turned coordinates, packed in bytes, with two numbers: its length and its inner
product with its own code. From them and the query's product with the centre the inner
product of vector and query is estimated without bias; the error is within BOUND /
sqrt(CODE_BITS - 1) times what the code leaves of the residual, with high probability.

Search, in two rounds. First a query meets one block of its nearest list; its k-th best
score there is a floor. Then it meets the other blocks: those of its NEAREST nearest
lists, by distance and by inner product, and those of every list that may hold a better
one. How far residuals reach in a query's direction is measured, not supposed: on up to
SPREAD_ROWS sampled residuals of each list, and on those of all lists together, whichever
is more. A list with n rows whose residuals are at most r long is left out if at that
spread fewer than missed / lists of its rows can be expected above the floor. In a block
the estimates give upper bounds; vectors are reranked with exact double-precision inner
products in the order of their bounds, until the bounds fall below the k-th best found
or the floor. With missed = 0 nothing is left to chance: lists are left out only where
no row can reach the floor (Cauchy and Schwarz), and bounds in blocks hold always. Equal vectors of a block are one candidate, with the k + 1 smallest ids
(of those no more than k can be in an answer). The best k of all blocks are the result.

Vectors that are null or zero, or that hold null or non-finite numbers, take no part,
nor do rows without a vec_id. Vectors of different lengths have no inner product; each
length is searched by itself, one after the other. Ties go to the smaller
vec_id. Rows with equal vec_id are candidates of their own, and not of a query with
that vec_id. Query rows of one vec_id with different vectors are queries of their own,
with ranks from 1 each; equal query rows are asked once. A query with fewer than k
candidates gets them all. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuelake.llm import kernels as K
from cuelake.llm.store import stored

SEED = 20240607
#: The error bound's factor; 1.9 holds for all but some in a thousand estimates.
BOUND = 1.9
#: The least length of a code.
CODE_BITS = 256
#: Rows on which centres are fitted, and bytes of them; rows that a list has on average, and the most lists.
SAMPLE_ROWS, SAMPLE_BYTES, LIST_ROWS, MOST_LISTS, ROUNDS = 65_536, 128 << 20, 2048, 4096, 8
#: Sampled residuals of a list on which its spread is measured, and bytes of those of all lists.
SPREAD_ROWS, SPREAD_BYTES = 64, 64 << 20
#: Rows of a block of a list.
BLOCK = 16_384
#: Lists that a query always meets; neighbours that it may miss in all lists that it doesn't.
NEAREST, MISSED = 4, 0.5
#: Vectors reranked at once, before the bounds are looked at again; queries whose bounds are worked out at once.
STEP, AT_ONCE = 64, 32

INDEX_SCHEMA = "list int, part int, vec_id long, v array<double>, residual double"
FOUND_SCHEMA = "query_id long, query_key long, vec_id long, score double"


def rotation(bits: int, dims: int) -> np.ndarray:
    """`dims` rows of a random orthogonal matrix, the same everywhere: vectors padded with zeros to `bits` coordinates and turned."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:dims]


def code_bits(dims: int) -> int:
    return max(CODE_BITS, -(-dims // 64) * 64)


def fit_centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres by k-means; a centre that loses all its rows stays where it was."""
    centres = sample[np.random.Generator(np.random.PCG64(SEED)).permutation(len(sample))[:lists]].copy()
    for _ in range(ROUNDS):
        own = nearest_centre(sample, centres)
        count = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
    return centres


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *(np.argmax(vectors[a : a + 4096] @ centres.T - half, axis=1) for a in range(0, len(vectors), 4096))])


class Codes:
    """One-bit codes of residuals with their correction numbers."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray, sure: bool = False):
        bits = turn.shape[1]
        residual = vectors - centre
        turned = residual @ turn
        self.length = np.linalg.norm(residual, axis=1)
        # inner product of the unit residual with its code, whose coordinates are +-1/sqrt(bits)
        own = np.abs(turned).sum(axis=1) / (np.sqrt(bits) * np.maximum(self.length, 1e-300))
        own = np.where(self.length > 0, np.maximum(own, 1e-6), 1.0)
        self.bytes = np.ascontiguousarray(np.packbits(turned > 0, axis=1, bitorder="little").T)
        self.scale = (self.length / (own * np.sqrt(bits))).astype(np.float32)
        # what the code leaves of a residual, times the query, is the error at most; in a random direction it is far less
        self.error = (self.length * (1 if sure else BOUND / np.sqrt(bits - 1)) * np.sqrt(np.maximum(1 - own**2, 0)) / own).astype(np.float32)
        self.centre = centre

    def upper_bounds(self, queries: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """For each query and vector the estimated inner product and the bound of its error added. Each byte of a code looks its part of the sum up in a table of the query."""
        turned = (queries @ turn).astype(np.float32).reshape(len(queries), -1, 8)
        tables = 2 * (turned @ _BYTE_BITS)
        total = np.zeros((len(queries), self.bytes.shape[1]), np.float32)
        for j, code in enumerate(self.bytes):
            total += tables[:, j].take(code, axis=1)
        total -= turned.sum(axis=(1, 2))[:, None]
        total *= self.scale
        total += np.linalg.norm(queries, axis=1).astype(np.float32)[:, None] * self.error
        # numbers of 24 bits: what they can be off is added, too
        return total + (queries @ self.centre)[:, None] + 1e-5 * np.linalg.norm(queries, axis=1)[:, None] * (np.linalg.norm(self.centre) + self.length)


_BYTE_BITS = ((np.arange(256) >> np.arange(8)[:, None]) & 1).astype(np.float32)


class Block:
    """The vectors of a block. Equal ones are one candidate with their k + 1 smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int, sure: bool = False):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        start = np.flatnonzero(new)
        self.turn, self.k = turn, k
        self.vectors = vectors[start]
        self.ids = [ids[a : min(b, a + k + 1)] for a, b in zip(start, np.append(start[1:], len(ids)), strict=True)]
        self.codes = Codes(self.vectors, centre, turn, sure)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray) -> Iterator[tuple[list[tuple[float, int]], int]]:
        """For each query the k best (score, vec_id) at or above its floor, and how many vectors were reranked."""
        for a in range(0, len(queries), AT_ONCE):
            bounds = self.codes.upper_bounds(queries[a : a + AT_ONCE], self.turn)
            for key, query, bound, floor in zip(query_ids[a : a + AT_ONCE].tolist(), queries[a : a + AT_ONCE], bounds, floors[a : a + AT_ONCE].tolist(), strict=True):
                yield self._best(key, query, bound, floor)

    def _best(self, key: int, query: np.ndarray, bound: np.ndarray, floor: float) -> tuple[list[tuple[float, int]], int]:
        able = np.flatnonzero(bound >= floor)
        order = able[np.argsort(-bound[able])]
        best: list[tuple[float, int]] = []
        looked = 0
        for a in range(0, len(order), STEP):
            part = order[a : a + STEP]
            if len(best) == self.k and bound[part[0]] < best[-1][0]:
                break
            looked += len(part)
            scores = exact(self.vectors[part], query)
            fine = np.flatnonzero(scores >= (floor if len(best) < self.k else best[-1][0]))
            fresh = [(s, i) for s, c in zip(scores[fine].tolist(), part[fine].tolist(), strict=True) for i in self.ids[c].tolist() if i != key]
            if fresh:
                best = sorted([*best, *fresh], key=lambda x: (-x[0], x[1]))[: self.k]
        return best, looked


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the coordinates, so that equal vectors score the same everywhere."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def usable(table: DataFrame) -> DataFrame:
    """Rows whose vector takes part, as (vec_id, v array<double>)."""
    own = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return own.where(fine)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def index(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(list, part, vec_id, v, residual) for every row: its list, a number by which the list is split, and the length of its residual."""
    dims = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), dims)
            own = nearest_centre(v, centres).astype(np.int32)
            residual = np.linalg.norm(v - centres[own], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(own), b.column("part"), b.column("vec_id"), b.column("v"), pa.array(residual)], ["list", "part", "vec_id", "v", "residual"])

    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit((1 << 31) - 1)).cast("int").alias("part")
    return rows.select(spread, "vec_id", "v").mapInArrow(K.releasing(run), INDEX_SCHEMA)


def meet(data: DataFrame, asked: DataFrame, centres: np.ndarray, units: int, k: int, sure: bool = False) -> DataFrame:
    """(query_id, query_key, vec_id, score): the best of each block for each query (unit, query_id, query_key, v, floor) that meets it; data has (unit, list, vec_id, v). The vectors of a block go before its queries, which pass by."""
    none = F.lit(None)
    both = data.select("unit", F.lit(0).alias("kind"), "list", "vec_id", none.cast("long").alias("key"), "v", none.cast("double").alias("floor"))
    both = both.union(asked.select("unit", F.lit(1), F.lit(-1), "query_id", "query_key", "v", "floor"))
    dealt = both.repartition(max(1, min(units, 20_000)), "unit").sortWithinPartitions("unit", "kind")
    dims = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(code_bits(dims), dims)
        now, ids, parts, ready = None, [], [], None
        for b in batches:
            unit, kind, number, vec_id = (b.column(c).to_numpy() for c in ("unit", "kind", "list", "vec_id"))
            key, floor = (b.column(c).fill_null(0).to_numpy() for c in ("key", "floor"))
            v = _matrix(b.column("v"), dims)
            cuts = np.flatnonzero((np.diff(unit, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(b)), strict=True):
                if unit[lo] != now:
                    now, ids, parts, ready = unit[lo], [], [], None
                if kind[lo] == 0:
                    ids.append(vec_id[lo:hi].copy())
                    parts.append(v[lo:hi].copy())
                    centre = centres[number[lo]]
                    continue
                if ready is None and parts:
                    ready = Block(np.concatenate(ids), np.concatenate(parts), centre, turn, k, sure)
                    ids, parts = [], []
                if ready is None:
                    continue
                out: tuple[list, list, list, list] = ([], [], [], [])
                for q, who, (best, _) in zip(vec_id[lo:hi].tolist(), key[lo:hi].tolist(), ready.search(vec_id[lo:hi], v[lo:hi], floor[lo:hi]), strict=True):
                    for score, vec in best:
                        for column, value in zip(out, (q, who, vec, score), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.float64())], ["query_id", "query_key", "vec_id", "score"])

    return dealt.mapInArrow(K.releasing(run), FOUND_SCHEMA)


class Spread:
    """How far unit residuals reach in a direction, measured on a sample: of each list, and of all."""

    def __init__(self, sample: np.ndarray, centres: np.ndarray):
        own = nearest_centre(sample, centres)
        residual = sample - centres[own]
        length = np.linalg.norm(residual, axis=1)
        unit = np.divide(residual, length[:, None], out=np.zeros_like(residual), where=length[:, None] > 0)
        moved = length > 0
        self.all = unit.T @ unit / max(1, int(moved.sum()))
        order = np.argsort(own, kind="stable")
        order = order[moved[order]]
        count = np.bincount(own[order], minlength=len(centres))
        most = max(2, min(SPREAD_ROWS, SPREAD_BYTES // max(1, 4 * len(centres) * sample.shape[1])))
        place = np.arange(len(order)) - np.repeat(np.cumsum(count) - count, count)
        order = order[place < most]
        self.count = np.minimum(count, most)
        self.unit = unit[order].astype(np.float32)

    def of(self, queries: np.ndarray) -> np.ndarray:
        """For each query and list the root mean square of the query's inner product with unit residuals, with what a small sample may be off."""
        whole = np.einsum("qi,ij,qj->q", queries, self.all, queries, optimize=True)
        squares = np.zeros((len(queries), len(self.count)))
        full = np.flatnonzero(self.count)
        if len(full):
            start = (np.cumsum(self.count) - self.count)[full]
            met = np.square(queries.astype(np.float32) @ self.unit.T)
            squares[:, full] = np.add.reduceat(met, start, axis=1) / self.count[full] * (1 + 2 * np.sqrt(2 / self.count[full]))
        return np.sqrt(np.maximum(squares, whole[:, None]))


def lists_to_meet(queries: np.ndarray, floors: np.ndarray, centres: np.ndarray, rows: np.ndarray, longest: np.ndarray, spread: Spread | None, missed: float) -> np.ndarray:
    """Which lists each query meets in the second round, as a matrix of yes and no. With missed = 0 all that may hold a row at or above the floor."""
    near = queries @ centres.T
    length = np.linalg.norm(queries, axis=1)[:, None]
    if missed <= 0:
        slack = 1e-9 * length * (np.linalg.norm(centres, axis=1) + longest)
        return (near + length * longest + slack >= floors[:, None]) & (rows > 0)
    # a score z times the spread above the list's mean has a chance under exp(-z * z / 2) / 2
    z = (floors[:, None] - near) / np.maximum(spread.of(queries) * longest, 1e-300)
    expected = rows * np.where(z > 0, np.exp(-np.square(np.clip(z, 0, 40)) / 2) / 2, 1.0)
    wanted = expected >= missed / len(centres)
    for far in ((centres**2).sum(axis=1) / 2 - near, -near):
        close = np.argpartition(far, min(NEAREST, len(centres)) - 1, axis=1)[:, :NEAREST]
        np.put_along_axis(wanted, close, True, axis=1)
    return wanted & (rows > 0)


ANSWER = "query_id long, rank int, vec_id long, score double"


def search(table: DataFrame, is_query, k: int = 20, block: int = BLOCK, list_rows: int = LIST_ROWS, missed: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest candidates that are found for each query row. `missed` (MISSED if not given) is how many neighbours a query may lack, as far as can be expected; with 0 it lacks none."""
    rows, missed = usable(table), MISSED if missed is None else missed
    out = table.sparkSession.createDataFrame([], ANSWER)
    for dims, total in sorted(tuple(r) for r in rows.groupBy(F.size("v")).count().collect()):  # a row for each length
        out = out.union(_search(rows.where(F.size("v") == dims), dims, total, is_query, k, block, list_rows, missed))
    return out


def _search(rows: DataFrame, dims: int, total: int, is_query, k: int, block: int, list_rows: int, missed: float) -> DataFrame:
    """search() among vectors of one length."""
    spark, sure = rows.sparkSession, missed <= 0
    lists = max(1, min(MOST_LISTS, total // list_rows))
    bound = max(lists, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims), 512 * lists))
    sample = rows.select("v", F.xxhash64("vec_id", "v").alias("_h")).orderBy("_h").limit(bound).toArrow()  # SAMPLE_ROWS vectors and SAMPLE_BYTES at most, but one for each list
    v = _matrix(sample["v"].combine_chunks(), dims)
    v = v[np.lexsort(v.T)]
    centres = fit_centres(v, lists)
    spread_of = None if sure else Spread(v, centres)
    listed = stored(index(rows, centres))
    known = {r["list"]: (r["n"], r["r"]) for r in listed.groupBy("list").agg(F.count("*").alias("n"), F.max("residual").alias("r")).collect()}  # MOST_LISTS rows at most
    count, longest = (np.array([known.get(i, (0, 0.0))[j] for i in range(lists)], dtype=float) for j in (0, 1))
    blocks = np.maximum(1, np.ceil(count / block)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(blocks)])
    units = int(first[-1])
    table_of = spark.createDataFrame([(i, int(first[i]), int(blocks[i])) for i in range(lists)], "list int, _first long, _blocks long")  # MOST_LISTS rows at most
    data = listed.join(F.broadcast(table_of), "list").select((F.col("_first") + F.col("part") % F.col("_blocks")).cast("int").alias("unit"), "list", "vec_id", "v")
    queries = listed.where(is_query).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "v").alias("query_key"), "list", "v")
    homes = queries.join(F.broadcast(table_of), "list").select(F.col("_first").cast("int").alias("unit"), "query_id", "query_key", "v", F.lit(float("-inf")).alias("floor"))
    near = stored(meet(data.where(F.col("part") % _blocks_of(blocks) == 0), homes, centres, lists, k, sure))
    floor = near.groupBy("query_key").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
    floored = queries.join(floor.where(F.col("n") >= k).drop("n"), "query_key", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                home = part.column("list").to_numpy()
                wanted = lists_to_meet(_matrix(part.column("v"), dims), part.column("floor").to_numpy(), centres, count, longest, spread_of, missed)
                row, own = np.nonzero(wanted)
                row, unit = np.repeat(row, blocks[own]), K.ranges(first[own], blocks[own])
                rest = unit != first[home[row]]  # that one it has met
                row, unit = pa.array(row[rest]), pa.array(unit[rest].astype(np.int32))
                yield pa.RecordBatch.from_arrays([unit, *(part.column(c).take(row) for c in ("query_id", "query_key", "v", "floor"))], ["unit", "query_id", "query_key", "v", "floor"])

    asked = floored.select("query_id", "query_key", "list", "v", "floor").mapInArrow(K.releasing(spread), "unit int, query_id long, query_key long, v array<double>, floor double")
    found = near.union(meet(data, asked, centres, units, k, sure))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks_of(blocks: np.ndarray):
    """The number of blocks of a row's list."""
    return F.element_at(F.lit([int(x) for x in blocks]), F.col("list") + 1)
