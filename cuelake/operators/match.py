"""Matching cues of two language versions by time. Results are one row for each match: (title_id, nl_pos, en_pos)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.operators import asof


def _en(en: DataFrame) -> DataFrame:
    return en.select("title_id", F.col("start_ms").alias("en_start_ms"), F.col("end_ms").alias("en_end_ms"), F.col("pos").alias("en_pos"), F.col("idx").alias("en_idx"))


def _nearest(nl: DataFrame, en: DataFrame, within: int) -> DataFrame:
    own = nl.select("title_id", F.col("pos").alias("nl_pos"), F.col("start_ms").alias("at"))
    near = asof.nearest(own, _en(en), "at", "en_start_ms", within=within, keep=["en_pos"])
    return near.where("nearest_en_pos is not null").select("title_id", "nl_pos", F.col("nearest_en_pos").alias("en_pos"))


def _in_window(rows: DataFrame, en: DataFrame, lo: Column, hi: Column) -> DataFrame:
    return asof.points_in(rows, _en(en), lo, hi, "en_start_ms")


def match_proximity(nl: DataFrame, en: DataFrame, tolerance: int = 500) -> DataFrame:
    """Cues that start between a cue's start and end, give or take the tolerance; the nearest within it otherwise."""
    own = nl.select("title_id", F.col("pos").alias("nl_pos"), "start_ms", "end_ms")
    inside = _in_window(own, en, F.col("start_ms") - tolerance, F.col("end_ms") + tolerance).select("title_id", "nl_pos", F.col("p_en_pos").alias("en_pos"))
    rest = _nearest(nl, en, tolerance).join(inside.select("title_id", "nl_pos").distinct(), ["title_id", "nl_pos"], "left_anti")
    return inside.unionByName(rest)


def draft_mapping(nl: DataFrame, en: DataFrame, tolerance: int = 500, fallback: int = 1000) -> DataFrame:
    """(title_id, nl_pos, nl_start_ms, nl_end_ms, en_indices, en_start_ms, en_end_ms): starts within the tolerance, else the nearest within the fallback."""
    own = nl.select("title_id", F.col("pos").alias("nl_pos"), F.col("start_ms").alias("nl_start_ms"), F.col("end_ms").alias("nl_end_ms"))
    band = _in_window(own, en, F.col("nl_start_ms") - tolerance, F.col("nl_start_ms") + tolerance).select("title_id", "nl_pos", F.col("p_en_pos").alias("en_pos"))
    rest = _nearest(nl, en, fallback).join(band.select("title_id", "nl_pos").distinct(), ["title_id", "nl_pos"], "left_anti")
    met = band.unionByName(rest).join(_en(en), ["title_id", "en_pos"])
    listed = met.groupBy("title_id", "nl_pos").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("en_pos", "en_idx"))), lambda x: x["en_idx"]).alias("en_indices"), F.min_by("en_start_ms", "en_pos").alias("en_start_ms"), F.max_by("en_end_ms", "en_pos").alias("en_end_ms")
    )
    return own.join(listed, ["title_id", "nl_pos"], "left").withColumn("en_indices", F.coalesce("en_indices", F.array().cast("array<int>")))


def _entry(rows: DataFrame, entries: DataFrame, at: str, moment: str, keys: list[str], tolerance: int) -> DataFrame:
    """For each row the first entry, in the order of `entry_no`, whose moment is within the tolerance."""
    met = asof.points_in(rows, entries, F.col(at) - tolerance, F.col(at) + tolerance, moment)
    order = Window.partitionBy("title_id", *keys).orderBy("p_entry_no")
    return met.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def _last_by_key(entries: DataFrame, key: str) -> DataFrame:
    """Entries with one key: the last one's values, at the first one's place."""
    return entries.groupBy("title_id", key).agg(F.max_by(F.struct(*[c for c in entries.columns if c not in ("title_id", key, "entry_no")]), "entry_no").alias("_v"), F.min("entry_no").alias("entry_no")).select("title_id", key, "entry_no", "_v.*")


def match_enhanced(nl: DataFrame, en: DataFrame, merges: DataFrame, drafts: DataFrame, tolerance: int = 500, near: int = 50) -> DataFrame:
    """Matches by precedence: the source windows of a merged cue, each by the draft mapping or else by proximity, and the nearest start if none has any; the draft mapping; proximity.

    merges: (title_id, entry_no, output_start_ms, source_timecodes). drafts: (title_id, entry_no, nl_start_ms, en_start_ms, en_end_ms).
    """
    own = nl.select("title_id", F.col("pos").alias("nl_pos"), "start_ms", "end_ms")
    drafts = _last_by_key(drafts.where("en_start_ms is not null").select("title_id", "entry_no", "nl_start_ms", F.col("en_start_ms").alias("from_ms"), F.col("en_end_ms").alias("to_ms")), "nl_start_ms")
    merges = _last_by_key(merges.select("title_id", "entry_no", "output_start_ms", "source_timecodes"), "output_start_ms")

    def by_draft(rows: DataFrame, at: str, keys: list[str]) -> DataFrame:
        found = _entry(rows, drafts, at, "nl_start_ms", keys, near)
        met = _in_window(found.select("title_id", *keys, "p_from_ms", "p_to_ms"), en, F.col("p_from_ms") - near, F.col("p_to_ms") + near)
        return met.select("title_id", *keys, F.col("p_en_pos").alias("en_pos"))

    hit = _entry(own, merges, "start_ms", "output_start_ms", ["nl_pos"], near).where(F.size("p_source_timecodes") > 0)
    windows = hit.select("title_id", "nl_pos", F.posexplode("p_source_timecodes").alias("w", "tc")).select("title_id", "nl_pos", "w", F.col("tc.start_ms").alias("w_start"), F.col("tc.end_ms").alias("w_end"))
    drafted = by_draft(windows, "w_start", ["nl_pos", "w"])
    rest = windows.join(drafted.select("title_id", "nl_pos", "w").distinct(), ["title_id", "nl_pos", "w"], "left_anti")
    ranged = _in_window(rest, en, F.col("w_start") - tolerance, F.col("w_end") + tolerance).select("title_id", "nl_pos", "w", F.col("p_en_pos").alias("en_pos"))
    merged = drafted.unionByName(ranged).select("title_id", "nl_pos", "en_pos").distinct()
    is_merge = hit.select("title_id", "nl_pos")
    lone = is_merge.join(merged.select("title_id", "nl_pos").distinct(), ["title_id", "nl_pos"], "left_anti")
    lone = _nearest(nl, en, tolerance).join(lone, ["title_id", "nl_pos"], "left_semi")
    plain = own.join(is_merge, ["title_id", "nl_pos"], "left_anti")
    second = by_draft(plain, "start_ms", ["nl_pos"]).distinct()
    third = match_proximity(nl, en, tolerance).join(is_merge, ["title_id", "nl_pos"], "left_anti").join(second.select("title_id", "nl_pos").distinct(), ["title_id", "nl_pos"], "left_anti")
    tagged = [df.withColumn("strategy", F.lit(name)) for df, name in ((merged, "merge"), (lone, "nearest"), (second, "draft"), (third, "proximity"))]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def title_cards(foreign: DataFrame, en: DataFrame, tolerance: int = 1500, min_ms: int = 400) -> DataFrame:
    """Foreign cues, long enough and not blank, that no cue starts near."""
    own = foreign.where((F.col("end_ms") - F.col("start_ms") >= min_ms) & (F.regexp_replace("text", r"(?U)\s", "") != ""))
    near = asof.nearest(own, en, "start_ms", "start_ms")
    return near.where(F.col("distance_ms").isNull() | (F.col("distance_ms") > tolerance)).drop("nearest_ms", "distance_ms")


def add_title_cards(cues: DataFrame, cards: DataFrame) -> DataFrame:
    """Cues and cards in one order, numbered anew."""
    card = cards.select("title_id", F.lit(1).alias("_k"), "pos", "start_ms", "end_ms", F.concat(F.lit('[TITLE CARD: "'), F.col("text"), F.lit('"]')).alias("text"))
    both = cues.select("title_id", F.lit(0).alias("_k"), "pos", "start_ms", "end_ms", "text").unionByName(card)
    order = Window.partitionBy("title_id").orderBy("start_ms", "_k", "pos")
    return both.select("title_id", F.row_number().over(order).cast("int").alias("idx"), "start_ms", "end_ms", "text")
