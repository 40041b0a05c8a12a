"""A Merkle manifest of a table: digests of rows, of groups, of all, and a proof for each row.

Rows of a group are leaves in order; ARITY consecutive nodes make a parent, whose digest
is that of their digests in a row, until one node is left, the group's subroot. Subroots
in the order of groups make a tree likewise, up to the root.

Parents are built by events. A digest that arrives is put, by its index, with its
siblings in a partial parent; how many siblings there are follows from the number of
leaves, so a parent knows when it is whole, and arrives itself one level up. combineByKey
does this in blocks of ARITY**LEVELS neighbouring nodes: each task closes what it has
whole, what is left open goes on with the block and meets its siblings after the
shuffle. A block yields one node; nodes of blocks are the leaves of the next round, so
rounds grow with a 12th of the binary logarithm of the rows. The children of closed
parents are kept with the block; read from the top down they give each node the digests
to its left and right at every level up to the root: its proof.

A block has at most ARITY**LEVELS rows, however large its group is; rows are ordered by
a range sort that also cuts through groups, equal ids and repeated rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.llm.store import stored

#: Children of a parent; levels of parents in a block.
ARITY, LEVELS = 8, 4

PROVEN = "doc_id long, leaf string, claimed string, subroot string, root string, proof array<struct<before:string,after:string>>"


def row_digest(*columns: str | Column) -> Column:
    """sha256 of the columns in a row: `-` for null, else the number of UTF-8 bytes, `:`, and the value."""
    told = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in told]).cast("binary"), 256)


def joined_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Block:
    """Partial and closed parents over a block of nodes of a level of `size` nodes. `top` is the block's own node, once it is whole; `rows` has (index, digest, what came with it)."""

    __slots__ = ("size", "levels", "partial", "links", "top", "rows")

    def __init__(self, size: int, levels: int = LEVELS):
        self.size, self.levels, self.partial, self.links, self.top, self.rows = size, levels, {}, {}, None, []

    def __reduce__(self):
        return _restore, (self.size, self.levels, self.partial, self.links, self.top, self.rows)

    def arrive(self, level: int, index: int, digest: str) -> None:
        """An event: a node is whole. Puts it in its partial parent; parents that become whole arrive in turn."""
        while True:
            width = -(-self.size // ARITY**level)
            if width == 1 or level == self.levels:
                self.top = digest
                return
            parent, child = divmod(index, ARITY)
            key = (level + 1, parent)
            children = self.partial.setdefault(key, {})
            children[child] = digest
            if len(children) < min(ARITY, width - ARITY * parent):
                return
            self.links[key] = own = [self.partial[key][k] for k in sorted(children)]
            del self.partial[key]
            level, index, digest = level + 1, parent, joined_digest(own)

    def add(self, row: tuple) -> Block:
        index, _, digest, rest = row
        self.rows.append((index, digest, rest))
        self.arrive(0, index, digest)
        return self

    def merge(self, other: Block) -> Block:
        self.rows += other.rows
        self.links |= other.links
        self.top = self.top or other.top
        for (level, parent), children in other.partial.items():
            for child, digest in children.items():
                self.arrive(level - 1, parent * ARITY + child, digest)
        return self

    def paths(self) -> Iterator[tuple[tuple, list[tuple[str, str]]]]:
        """(row, digests to the left and right at each level up to the block's top) for each row, by the links back from parents."""
        known: dict[tuple[int, int], list] = {}

        def path(level: int, index: int) -> list[tuple[str, str]]:
            if (found := known.get((level, index))) is None:
                parent, child = divmod(index, ARITY)
                siblings = self.links.get((level + 1, parent))
                if siblings is None:
                    found = []
                else:
                    found = [("".join(siblings[:child]), "".join(siblings[child + 1 :])), *path(level + 1, parent)]
                if level:
                    known[level, index] = found
            return found

        for row in self.rows:
            yield row, path(0, row[0])


def _restore(size: int, levels: int, partial: dict, links: dict, top: str | None, rows: list) -> Block:
    out = Block(size, levels)
    out.partial, out.links, out.top, out.rows = partial, links, top, rows
    return out


def placed(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with `at`, the place of each row among those of its group from 0, and `size`, how many there are. Ties beyond `order` are in no fixed order."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    ranged = stored(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie"))
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    counted = numbered.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in")).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_group")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select("_group", "_in", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"))
    met = numbered.join(counted, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in")))
    return met.select(*df.columns, (F.col("_row") + F.col("_shift")).alias("at"), "size")


def rounds(nodes: DataFrame, group_type: str, levels: int = LEVELS) -> list[DataFrame]:
    """Blocks of each round over nodes (grp, at, size, digest, rest): (grp, block, width, top, state), width being the number of the group's blocks."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out, block = [], ARITY**levels
    while True:
        events = nodes.select("grp", "at", "size", "digest", "rest").rdd.map(lambda r: ((r[0], r[1] // block), (r[1], r[2], r[3], r[4])))
        blocks = events.combineByKey(lambda row: Block(row[1], levels).add(row), Block.add, Block.merge, parts)
        made = blocks.map(lambda kv: (kv[0][0], kv[0][1], -(-kv[1].size // block), kv[1].top, pickle.dumps(kv[1], protocol=5)))
        out.append(stored(spark.createDataFrame(made, f"grp {group_type}, block long, width long, top string, state binary", verifySchema=False)))
        nodes = out[-1].where("width > 1").select("grp", F.col("block").alias("at"), F.col("width").alias("size"), F.col("top").alias("digest"), F.lit(None).cast("binary").alias("rest"))
        if nodes.isEmpty():
            return out


def _expand(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """(block, state, path) of each block of a round that has a path."""
    paths = paths.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path")
    return blocks.join(paths, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))).select("grp", "block", "state", "path")


def descend(made: list[DataFrame], paths: DataFrame, group_type: str) -> DataFrame:
    """From the paths of the groups' tops (grp, path) to those of the blocks of the first round, (grp, block, path); path is pickled: (subroot, root, digests on both sides by level)."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grp, state, above in zip(b.column("grp"), b.column("state").to_pylist(), b.column("path").to_pylist(), strict=True):
                subroot, root, levels = pickle.loads(above)
                at, own = [], []
                for (index, _, _), path in pickle.loads(state).paths():
                    at.append(index)
                    own.append(pickle.dumps((subroot, root, path + levels), protocol=5))
                yield pa.RecordBatch.from_arrays([pa.array([grp.as_py()] * len(at), b.column("grp").type), pa.array(at, pa.int64()), pa.array(own, pa.binary())], ["grp", "block", "path"])

    known = None
    for blocks in reversed(made):
        ends = blocks.where("width = 1").select(F.col("grp").alias("_end")).join(paths, F.col("_end").eqNullSafe(F.col("grp"))).select("grp", F.lit(0).cast("long").alias("block"), "path")
        known = ends if known is None else ends.union(known)
        if blocks is not made[0]:
            known = stored(_expand(blocks, known).mapInArrow(down, f"grp {group_type}, block long, path binary"))
    return known


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs for rows (grp string, doc_id, leaf, claimed): leaves of a group in the order of doc_id, null first, then leaf; groups in the order of their bytes, null first.

    Returns PROVEN: for each row its leaf, the digest that it is claimed to have, its
    group's subroot, the root, and for each level the digests to its left and right.
    Repeated rows are leaves of their own. An empty table gives an empty result.
    """
    spark = leaves.sparkSession
    own = stored(leaves.select("grp", F.col("doc_id").cast("long").alias("doc_id"), "leaf", "claimed"))
    if own.isEmpty():
        return spark.createDataFrame([], PROVEN)
    rest = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.when(F.col("claimed") != F.col("leaf"), F.col("claimed"))).cast("binary")
    by_group = rounds(placed(own, "grp", ["doc_id", "leaf"]).select("grp", "at", "size", F.col("leaf").alias("digest"), rest.alias("rest")), "string", levels)
    tops = None
    for blocks in by_group:
        end = blocks.where("width = 1").select(F.lit(0).alias("all"), "grp", "top")
        tops = end if tops is None else tops.union(end)
    over = placed(stored(tops), "all", ["grp"]).select(F.col("all").alias("grp"), "at", "size", F.col("top").alias("digest"), F.encode("grp", "utf-8").alias("rest"))
    above = rounds(over, "int", levels)
    root = above[-1].where("width = 1").first()["top"]
    paths = descend(above, spark.createDataFrame([(0, pickle.dumps((None, root, [])))], "grp int, path binary"), "int")

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for state, known in zip(b.column("state").to_pylist(), b.column("path").to_pylist(), strict=True):
                _, root, levels = pickle.loads(known)
                rows = [(None if name is None else bytes(name).decode(), pickle.dumps((digest, root, path + levels), protocol=5)) for (_, digest, name), path in pickle.loads(state).paths()]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["grp", "path"])

    subroots = stored(_expand(above[0], paths).mapInArrow(to_groups, "grp string, path binary"))
    known = descend(by_group, subroots, "string")

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        for b in batches:
            for state, path in zip(b.column("state").to_pylist(), b.column("path").to_pylist(), strict=True):
                subroot, root, levels = pickle.loads(path)
                ids, leaf, claimed, before, after, cuts = [], [], [], [], [], [0]
                for (_, digest, rest), inside in pickle.loads(state).paths():
                    told = bytes(rest).decode().split(" ")
                    ids.append(None if told[0] == "-" else int(told[0]))
                    leaf.append(digest)
                    claimed.append(told[1] if len(told) > 1 else digest)
                    for x, y in inside + levels:
                        before.append(x)
                        after.append(y)
                    cuts.append(len(before))
                n = len(ids)
                proof = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leaf), pa.array(claimed), pa.array([subroot] * n), pa.array([root] * n), proof.cast(shape)], ["doc_id", "leaf", "claimed", "subroot", "root", "proof"])

    return _expand(by_group[0], known).mapInArrow(to_rows, PROVEN)


def verified(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Every row of documents as a leaf in the tree of its language, checked against its proof; every third text, by the checksum of its id, is claimed in lower case (A-Z). A row without an id is claimed as it is."""
    own = docs.select("doc_id", "source", "lang", "n_chars", "text")
    upper = "".join(map(chr, range(65, 91)))
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = row_digest("doc_id", "source", "lang", "n_chars", "text")
    other = F.when(changed & F.col("text").rlike("[A-Z]"), row_digest("doc_id", "source", "lang", "n_chars", F.translate("text", upper, upper.lower())))
    leaves = own.select(F.col("lang").cast("string").alias("grp"), "doc_id", leaf.alias("leaf"), other.alias("other"))
    proven = manifest(leaves.select("grp", "doc_id", "leaf", F.coalesce("other", "leaf").alias("claimed")), levels)
    siblings = F.array_join(F.transform("proof", lambda x: F.concat(x["before"], x["after"])), "")
    folded = F.aggregate("proof", F.col("claimed"), lambda now, x: F.sha2(F.concat(x["before"], now, x["after"]).cast("binary"), 256))
    out = proven.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: verified() in DuckDB SQL: levels of all groups by recursion, then of their tops, then each row folded up.
ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM (SELECT DISTINCT doc_id FROM documents)
), told AS (
  SELECT d.*, coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         CASE WHEN h % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed
  FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS claimed FROM told
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size FROM leaves
), nodes(lang, level, place, size, h) AS (
  SELECT lang, 0, place, size, leaf FROM placed
  UNION ALL SELECT lang, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM nodes WHERE size > 1 GROUP BY lang, level + 1, place // 8, (size + 7) // 8
), tops AS (
  SELECT lang, level, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1
), upper(level, place, size, h) AS (
  SELECT 0, place, size, h FROM tops
  UNION ALL SELECT level + 1, place // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM upper WHERE size > 1 GROUP BY level + 1, place // 8, (size + 7) // 8
), sides AS (
  SELECT n.lang, n.level, n.place, coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place < n.place), '') AS before, coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place > n.place), '') AS after
  FROM nodes n JOIN nodes s ON n.lang IS NOT DISTINCT FROM s.lang AND n.level = s.level AND n.place // 8 = s.place // 8 WHERE n.size > 1 GROUP BY ALL
), upper_sides AS (
  SELECT n.level, n.place, coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place < n.place), '') AS before, coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place > n.place), '') AS after
  FROM upper n JOIN upper s ON n.level = s.level AND n.place // 8 = s.place // 8 WHERE n.size > 1 GROUP BY ALL
), steps AS (
  SELECT p.doc_id, p.leaf, s.level, s.before, s.after FROM placed p JOIN sides s ON p.lang IS NOT DISTINCT FROM s.lang AND s.place = p.place // (8 ** s.level)::BIGINT
  UNION ALL SELECT p.doc_id, p.leaf, t.level + s.level, s.before, s.after FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang JOIN upper_sides s ON s.place = t.place // (8 ** s.level)::BIGINT
), proofs AS (
  SELECT doc_id, leaf, sha256(string_agg(before || after, '' ORDER BY level)) AS proof, list({'before': before, 'after': after} ORDER BY level) AS path FROM steps GROUP BY doc_id, leaf
), folded(doc_id, leaf, now, path) AS (
  SELECT p.doc_id, p.leaf, claimed, coalesce(path, []) FROM placed p LEFT JOIN proofs q ON p.doc_id = q.doc_id AND p.leaf = q.leaf
  UNION ALL SELECT doc_id, leaf, sha256(path[1].before || now || path[1].after), path[2:] FROM folded WHERE len(path) > 0
)
SELECT p.doc_id, p.leaf, t.h AS subroot, u.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.now AS folded_root, f.now = u.h AS verified
FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang JOIN upper u ON u.size = 1 LEFT JOIN proofs q ON p.doc_id = q.doc_id AND p.leaf = q.leaf JOIN folded f ON p.doc_id = f.doc_id AND p.leaf = f.leaf AND len(f.path) = 0
"""
