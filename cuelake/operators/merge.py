"""Merging of adjacent cues: greedy, left to right.

What doesn't depend on earlier decisions is decided for all cues at once: a gap over
the threshold and a no-merge marker always break, which cuts titles into short runs.
Inside a run one fold carries the open group; runs are independent of each other, so a
long title is as parallel as many short ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.operators.timing import NL, by_pos

def joined_text(one: Column, two: Column, speaker_change: Column, width: int, most: int) -> Column:
    """The text of two cues as one, or null if it can't be: dual-speaker form, or both refilled without the ellipses between them."""
    added = F.concat(T.strip(one), F.lit("\n-"), F.regexp_replace(T.strip(two), "^- *", ""))
    parts = F.split(added, "\n")
    dual = F.when((F.size(parts) <= most) & F.forall(parts, lambda x: T.visible_length(x) <= width), added)
    left, right = F.regexp_replace(T.collapse(one), r"\s*\.\.\.$", ""), F.regexp_replace(T.collapse(two), r"^\.\.\.\s*", "")
    same = F.when(~T.is_dual_speaker(one) & ~T.is_dual_speaker(two), T.wrap_text(F.concat(left, F.lit(" "), right), width, most))
    return F.when(speaker_change, dual).otherwise(same)


def merge_cues(cues: DataFrame, gap_threshold_ms: int = 1000, max_duration_ms: int = NL["max_duration_ms"], most_lines: int = 2, width: int = 42) -> DataFrame:
    """(title_id, idx, start_ms, end_ms, text, source_count, source_indices, source_timecodes, gap_ms, combined_duration_ms): one row for each cue that comes out; source_count over 1 where cues were merged."""
    own = marked(cues)
    gap = F.col("start_ms") - F.lag("end_ms").over(by_pos())
    own = own.withColumn("breaks", (F.coalesce(gap > gap_threshold_ms, F.lit(True)) | (F.col("m") == "NM")).cast("int"))
    own = own.withColumn("run", F.sum("breaks").over(by_pos()))
    runs = own.groupBy("title_id", "run").agg(F.array_sort(F.collect_list(F.struct("pos", "idx", "start_ms", "end_ms", "m", "clean"))).alias("c"))
    out = fold_runs(runs.select("title_id", "c"), max_duration_ms, most_lines, width)
    number = F.row_number().over(Window.partitionBy("title_id").orderBy("first_pos"))
    return out.select("title_id", number.alias("idx"), "start_ms", "end_ms", "text", "source_count", "source_indices", "source_timecodes", "gap_ms", (F.col("end_ms") - F.col("start_ms")).alias("combined_duration_ms"))


#: A run: what merging needs of cues between which no gap and no marker breaks.
RUN = "array<struct<pos: bigint, idx: int, start_ms: bigint, end_ms: bigint, m: string, clean: string>>"


def marked(cues: DataFrame) -> DataFrame:
    """Cues with their marker, `m`, and their text without it, `clean`."""
    return cues.withColumn("m", T.marker(F.col("text"))).withColumn("clean", T.unmarked(F.col("text")))


def fold_runs(runs: DataFrame, max_duration_ms: int = NL["max_duration_ms"], most_lines: int = 2, width: int = 42) -> DataFrame:
    """Merged cues of rows with a run, `c` (RUN): first_pos tells which cue comes first; other columns pass. A row by itself, so that it works on a stream, too."""
    rest = [c for c in runs.columns if c != "c"]
    # the open group is all that a step needs; where a group begins is noted, and its figures are taken from its cues afterwards
    state = "struct<start_ms: bigint, text: string, n: int, begins: array<int>, texts: array<string>>"

    def opened(s: Column, c: Column, at: Column) -> Column:
        done = F.when(s["n"] == 0, s["texts"]).otherwise(F.concat(s["texts"], F.array(s["text"])))
        return F.struct(c["start_ms"].alias("start_ms"), c["clean"].alias("text"), F.lit(1).alias("n"), F.concat(s["begins"], F.array(at)).alias("begins"), done.alias("texts"))

    def step(s: Column, c: Column) -> Column:
        change = c["m"] == "SC"
        can = (s["n"] > 0) & (c["end_ms"] - s["start_ms"] <= max_duration_ms) & ~(change & (s["n"] > 1))
        text = F.when(can, joined_text(s["text"], c["clean"], change, width, most_lines))
        grown = T.bound(text, lambda t: F.when(t.isNull(), opened(s, c, c["at"]).cast(state)).otherwise(F.struct(s["start_ms"].alias("start_ms"), t.alias("text"), (s["n"] + 1).alias("n"), s["begins"].alias("begins"), s["texts"].alias("texts")).cast(state)))
        return grown

    empty = F.struct(F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(0), F.array().cast("array<int>"), F.array().cast("array<string>")).cast(state)
    folded = runs.withColumn("c", F.transform("c", lambda x, i: x.withField("at", i + 1))).withColumn("s", F.aggregate("c", empty, step))
    folded = folded.withColumn("texts", F.concat("s.texts", F.array("s.text"))).withColumn("begins", F.col("s.begins"))
    groups = folded.select(*rest, "c", "begins", F.posexplode("texts").alias("g", "text"))
    begin, after = F.element_at("begins", F.col("g") + 1), F.coalesce(F.try_element_at("begins", F.col("g") + 2), F.size("c") + 1)
    groups = groups.select(*rest, "text", F.slice("c", begin, after - begin).alias("c"))
    first, last, n = F.element_at("c", 1), F.element_at("c", -1), F.size("c")
    return groups.select(
        *rest, first["pos"].alias("first_pos"), first["start_ms"].alias("start_ms"), last["end_ms"].alias("end_ms"), "text", n.alias("source_count"), F.transform("c", lambda x: x["idx"]).alias("source_indices"),
        F.transform("c", lambda x: F.struct(x["start_ms"].alias("start_ms"), x["end_ms"].alias("end_ms"))).alias("source_timecodes"), F.when(n > 1, F.try_element_at("c", F.lit(2))["start_ms"] - first["end_ms"]).otherwise(0).alias("gap_ms"),
    )


def drop_trivial(cues: DataFrame) -> DataFrame:
    """Without cues that only acknowledge. Not part of merging; an option of its own."""
    return cues.where(~T.is_trivial_reply(T.unmarked(F.col("text"))))


def with_report(cues: DataFrame, reported: DataFrame) -> DataFrame:
    """Cues with what a merge report says of them, by number: how many cues they were made of, and which; null for those that the report doesn't have."""
    told = reported.select("title_id", F.col("output_index").alias("idx"), "source_count", "source_indices", "gap_ms")
    return cues.join(told, ["title_id", "idx"], "left")


def report(merged: DataFrame) -> DataFrame:
    """The merge report: one row for each cue that was merged from several."""
    return merged.where("source_count > 1").select(
        "title_id", F.col("idx").alias("output_index"), F.col("start_ms").alias("output_start_ms"), F.col("end_ms").alias("output_end_ms"), "source_indices", "source_timecodes", "source_count", "gap_ms", "combined_duration_ms", "text"
    )
