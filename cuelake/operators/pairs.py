"""Aligned groups of two language versions: cues that overlap in time, and what connects them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import text as T

CATEGORIES = ("heavy-merge", "merge", "strong-condensation", "condensation", "idiom-candidate", "dual-speaker", "v2-inversion", "register-formal", "register-informal", "continuation", "expansion")


#: Pairs of cues that a task looks at together.
PAIRS = 1_000_000


def _connect(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (of each node the least node of its component) after the edges a-b: roots are hung on smaller roots until both ends of every edge agree."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels


def _overlap_groups(percent: int):
    """A function of the sides, positions, starts and ends of each island's cues that lists its groups: e and n, the places in the island of a group's cues of both sides by start.

    Cues are sorted by start, so that those which a cue overlaps stand right behind it; these pairs alone are looked at, PAIRS at a time.
    """

    def solve(side: pa.Array, pos: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
        sizes = np.diff(side.offsets.to_numpy())
        island, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        known = start.flatten().is_valid().to_numpy(zero_copy_only=False) & end.flatten().is_valid().to_numpy(zero_copy_only=False)
        # a cue without times is one without duration: it meets no other
        side, pos, start, end = (pc.fill_null(x.flatten(), 0).to_numpy(zero_copy_only=False) for x in (side, pos, start, end))
        end = np.where(known, end, start)
        order = np.lexsort((pos, side, start, island))
        island, place, side, pos, start, end = (x[order] for x in (island, place, side, pos, start, end))
        times, ranks = np.unique(np.concatenate([start, end]), return_inverse=True)
        first = island * len(times)
        behind = np.arange(len(start)) + 1
        met = np.maximum(np.searchsorted(first + ranks[: len(start)], first + ranks[len(start) :]) - behind, 0)
        upto = np.cumsum(met)
        labels, at = np.arange(len(start)), 0
        while at < len(start):
            done = upto[at - 1] if at else 0
            to = max(int(np.searchsorted(upto, done + PAIRS, side="right")), at + 1)
            a = np.repeat(np.arange(at, to), met[at:to])
            b = behind[a] + np.arange(len(a)) - (upto[a] - met[a] - done)
            shared, shorter = np.minimum(end[a], end[b]) - start[b], np.minimum(end[a] - start[a], end[b] - start[b])
            edge = (side[a] != side[b]) & (shared > 0) & (shared * 100 >= percent * shorter)
            labels, at = _connect(labels, a[edge], b[edge]), to
        root = np.flatnonzero(labels == np.arange(len(labels)))
        group = np.searchsorted(root, labels)

        def places(of: int) -> pa.Array:
            own = np.flatnonzero(side == of)
            own = own[np.lexsort((pos[own], start[own], group[own]))]
            return pa.ListArray.from_arrays(_offsets(np.bincount(group[own], minlength=len(root))), pa.array(place[own], pa.int32()))

        return pa.ListArray.from_arrays(_offsets(np.bincount(island[root], minlength=len(sizes))), pa.StructArray.from_arrays([places(0), places(1)], ["e", "n"]))

    return F.arrow_udf(solve, "array<struct<e: array<int>, n: array<int>>>")


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def _components(edges: DataFrame) -> DataFrame:
    """(title_id, side, pos, root): what edges (title_id, en_pos, nl_pos) that are given as a table connect, title by title."""

    def solve(rows: pa.Table) -> pa.Table:
        (en, a), (nl, b) = (np.unique(rows[c].to_numpy(), return_inverse=True) for c in ("en_pos", "nl_pos"))
        root = en[_connect(np.arange(len(en) + len(nl)), a, b + len(en))]
        return pa.table({"title_id": pa.repeat(rows["title_id"][0], len(root)), "side": pa.array(np.repeat([0, 1], [len(en), len(nl)]), pa.int32()), "pos": np.concatenate([en, nl]), "root": root})

    return edges.groupBy("title_id").applyInArrow(solve, "title_id string, side int, pos bigint, root bigint")


def align(en: DataFrame, nl: DataFrame, percent: int = 10) -> DataFrame:
    """One row for each group: counts, texts, characters, times, mapping type. Cues that meet no other are groups of their own.

    Both versions are sorted together by title and start and cut in islands where every cue so far has ended; groups are found island by island.
    Versions that are dealt alike by title are not dealt again, and nothing is joined: an island has all that its groups are made of.
    """

    def own(df: DataFrame, side: int) -> DataFrame:
        text = F.col("text")
        return df.select("title_id", F.lit(side).alias("side"), "pos", "idx", "start_ms", "end_ms", F.regexp_replace(text, "\n", " ").alias("flat"), T.char_count(text).alias("chars"), (T.is_dual_speaker(text) if side else F.lit(False)).alias("dual"))

    order = Window.partitionBy("title_id").orderBy("start_ms", "side", "pos")
    both = own(en, 0).unionByName(own(nl, 1)).withColumn("_before", F.max("end_ms").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    cut = F.coalesce((F.col("start_ms") >= F.col("_before")) | F.col("title_id").isNull(), F.lit(True)).cast("int")
    both = both.withColumn("_island", F.sum(cut).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = both.groupBy("title_id", "_island").agg(F.collect_list(F.struct("side", "pos", "idx", "start_ms", "end_ms", "flat", "chars", "dual")).alias("c"))
    islands = islands.withColumn("_groups", _overlap_groups(percent)("c.side", "c.pos", "c.start_ms", "c.end_ms"))
    met = islands.select("title_id", F.inline(F.transform("_groups", lambda g: F.struct(*(F.transform(g[k], lambda i: F.get("c", i)).alias(k) for k in ("e", "n"))))))
    e, n = F.col("e"), F.col("n")

    def chars(side: Column) -> Column:
        return F.aggregate(side["chars"], F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))

    def first(side: Column) -> Column:
        return F.coalesce(F.get(side["idx"], F.lit(0)), F.lit(0))

    name = F.when(F.size(n) == 0, F.concat(F.lit("e"), F.get("e.pos", F.lit(0)))).when(F.size(e) == 0, F.concat(F.lit("n"), F.get("n.pos", F.lit(0)))).otherwise(F.concat(F.lit("g"), F.array_min("e.pos")))
    groups = met.select(
        "title_id", name.alias("group_key"), F.size(e).cast("bigint").alias("en_count"), F.size(n).cast("bigint").alias("nl_count"), F.array_join("e.flat", " ").alias("en_text"), F.array_join("n.flat", " ").alias("nl_text"),
        chars(e).alias("en_chars"), chars(n).alias("nl_chars"), first(e).alias("en_first"), first(n).alias("nl_first"), F.coalesce(F.array_min("e.start_ms"), F.array_min("n.start_ms")).alias("at_ms"),
        (F.greatest(F.array_max("e.end_ms"), F.array_max("n.end_ms")) - F.least(F.array_min("e.start_ms"), F.array_min("n.start_ms"))).alias("span_ms"), F.array_max(F.concat("e.dual", "n.dual")).alias("dual"),
    )
    n, m = F.col("en_count"), F.col("nl_count")
    kind = F.when((n == 1) & (m == 1), "1:1").when((n > 1) & (m == 1), F.concat(n, F.lit(":1 merge"))).when((n == 1) & (m > 1), F.concat(F.lit("1:"), m, F.lit(" split"))).otherwise(F.concat(n, F.lit(":"), m, F.lit(" remap")))
    # in millionths, so that it is exact
    ratio = F.when(F.col("en_chars") == 0, 1000000).otherwise(F.floor(F.col("nl_chars") * 1000000 / F.col("en_chars"))).cast("bigint")
    return groups.withColumn("merge_type", kind).withColumn("ratio", ratio)


def _found(groups: DataFrame) -> tuple[DataFrame, Column]:
    """Groups whose texts and counts are worked out once, as they are looked at many times, and the categories of each as an array."""
    groups = T.once(groups, **{c: F.col(c) for c in groups.columns if c != "title_id"}).select(*groups.columns)
    n, m = F.col("en_count"), F.col("nl_count")
    a, b = F.col("en_chars"), F.col("nl_chars")
    whole = F.when(a == 0, F.lit(1)).otherwise(a)
    part = F.when(a == 0, F.lit(1)).otherwise(b)
    reg = T.register(F.col("nl_text"))
    found = F.array(
        F.when((n >= 2) & (m == 1), "merge"),
        F.when((n >= 3) & (m <= 2), "heavy-merge"),
        F.when((part * 100 >= 40 * whole) & (part * 100 <= 65 * whole), "strong-condensation"),
        F.when((part * 100 > 65 * whole) & (part * 100 <= 80 * whole), "condensation"),
        F.when((part * 100 > 115 * whole) & (a > 10), "expansion"),
        F.when(F.col("dual"), "dual-speaker"),
        F.when((n <= 2) & (m <= 2) & T.is_idiom_candidate(F.col("en_text"), F.col("nl_text")), "idiom-candidate"),
        F.when(reg.isNotNull(), F.concat(F.lit("register-"), reg)),
        F.when(T.has_inversion(F.col("nl_text")), "v2-inversion"),
        F.when(F.col("nl_text").contains("..."), "continuation"),
    )
    return groups, F.filter(found, lambda c: c.isNotNull())


def categories(groups: DataFrame) -> DataFrame:
    """Groups with `category`, one row for each pattern that a group shows."""
    own, found = _found(groups)
    return own.withColumn("category", F.explode(found))


def kinds(groups: DataFrame) -> DataFrame:
    """(title_id, kind, name): the mapping type of each group and each category, found in one pass over the groups."""
    own, found = _found(groups)

    def named(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"))

    return own.select("title_id", F.inline(F.concat(F.array(named("mapping", F.col("merge_type"))), F.transform(found, lambda c: named("category", c)))))


def exemplars(categorised: DataFrame, most: int = 30) -> DataFrame:
    """The first `most` groups of each category of a title: condensed ones by ratio, expanded ones by falling ratio, others by time; short ones only if they have two speakers."""
    own = categorised.where((F.col("en_chars") >= 15) | F.col("dual")).where(F.col("category").isin(*CATEGORIES))
    order = F.when(F.col("category").contains("condensation") | F.col("category").contains("merge"), F.col("ratio")).when(F.col("category") == "expansion", -F.col("ratio")).otherwise(0)
    rank = F.row_number().over(Window.partitionBy("title_id", "category").orderBy("_o", "at_ms", "group_key"))
    return own.withColumn("_o", order).withColumn("rank", rank).where(F.col("rank") <= most).drop("_o")
