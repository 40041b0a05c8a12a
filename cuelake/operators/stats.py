"""Figures by title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import linebreak as L
from cuelake.functions import text as T
from cuelake.operators.timing import NL


def metrics(cues: DataFrame) -> DataFrame:
    """Lengths and reading speed of each cue; micro_cps in millionths."""
    duration = F.col("end_ms") - F.col("start_ms")
    parts = T.lines(F.col("text"))
    return cues.select(
        "title_id", "pos", duration.alias("duration_ms"), T.char_count(F.col("text")).alias("chars"), T.micro_cps(F.col("text"), duration).alias("micro_cps"), F.size(parts).alias("line_count"), F.array_max(F.transform(parts, F.length)).alias("max_line_length")
    )


def validation(cues: DataFrame) -> DataFrame:
    own = metrics(cues)
    chars, duration = F.col("chars"), F.col("duration_ms")
    timed = duration > 0
    return own.groupBy("title_id").agg(
        F.count("*").alias("total_cues"), F.sum("chars").cast("bigint").alias("total_chars"), F.sum("duration_ms").alias("total_duration_ms"), F.max("micro_cps").alias("cps_max"), F.min("micro_cps").alias("cps_min"),
        F.floor(F.sum("micro_cps") / F.count("micro_cps")).cast("bigint").alias("cps_avg"), F.count_if(timed & (chars * 1000 > NL["cps_soft_ceiling"] * duration)).alias("cps_above_soft"), F.count_if(timed & (chars * 1000 > NL["cps_hard_limit"] * duration)).alias("cps_above_hard"),
    )


def summary(cues: DataFrame, violations: DataFrame, drift: DataFrame | None = None, parse_errors: DataFrame | None = None) -> DataFrame:
    """Errors and warnings of each title, and whether it has no error: of the rules, of runs that drift from the source, and one for each block that could not be read."""
    found = violations.select("title_id", "severity")
    if drift is not None:
        found = found.unionByName(drift.select("title_id", "severity"))
    if parse_errors is not None:
        found = found.unionByName(parse_errors.select("title_id", F.lit("error").alias("severity")))
    hits = found.groupBy("title_id").agg(F.count_if(F.col("severity") == "error").alias("error_count"), F.count_if(F.col("severity") == "warning").alias("warning_count"))
    titles = cues.groupBy("title_id").agg(F.count("*").alias("total_cues")).join(hits, "title_id", "left").na.fill(0, ["error_count", "warning_count"])
    return titles.withColumn("valid", F.col("error_count") == 0)


def merges(merged: DataFrame) -> DataFrame:
    """Cues before and after, and the ratio in tenths of a percent, for each title."""
    own = merged.groupBy("title_id").agg(F.sum("source_count").alias("source_cues"), F.count("*").alias("output_cues"), F.count_if(F.col("source_count") > 1).alias("merges"), F.sum(F.when(F.col("source_count") > 1, F.col("source_count")).otherwise(0)).alias("cues_merged"))
    return own.withColumn("ratio_permille", permille(F.col("output_cues"), F.col("source_cues")))


def permille(part: Column, whole: Column) -> Column:
    """Tenths of a percent, rounded, halves to even; null of nothing."""
    return F.when(whole > 0, F.bround(part * 1000 / whole)).cast("bigint")


def in_genre_ranges(rows: DataFrame, genres: DataFrame, part: str, whole: str, lo: str, hi: str) -> DataFrame:
    """rows with each genre and whether part of whole is in its range of percent, exactly, not as it is rounded. The genres are a fixed table of four rows."""
    ranges = genres.select("genre", lo, hi).withColumn("_one", F.lit(1))
    hundredfold = F.col(part) * 100
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(ranges), "_one").drop("_one").withColumn("in_range", (hundredfold >= F.col(lo) * F.col(whole)) & (hundredfold <= F.col(hi) * F.col(whole))).drop(lo, hi)


def dual_speakers(cues: DataFrame) -> DataFrame:
    own = cues.groupBy("title_id").agg(F.count("*").alias("total_cues"), F.count_if(T.is_dual_speaker(F.col("text"))).alias("dual_cues"))
    return own.withColumn("permille", permille(F.col("dual_cues"), F.col("total_cues")))


def trims(decisions: DataFrame) -> DataFrame:
    """Number and milliseconds by action and reason, ranked by number. A row for each action and reason, so that one task ranks a handful."""
    own = decisions.groupBy("action", "reason").agg(F.count("*").alias("n"), F.sum("trim_ms").cast("bigint").alias("total_trim_ms"))
    return own.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "action", F.asc_nulls_first("reason"))))


def trim_counts(decisions: DataFrame, listed: Column | None = None) -> DataFrame:
    """Cues of each title by what trimming did, the time it took off, and reasons, (-n, reason) in order, why cues were left. `listed` of each trimmed cue is gathered in the same pass, in order, as rows."""
    cut = F.col("action").isin("trim", "partial_trim")
    gathered = [] if listed is None else [F.collect_list(F.when(F.col("action") != "skip", listed)).alias("rows")]
    counted = decisions.groupBy("title_id", "action", "reason").agg(F.count("*").alias("n"), F.coalesce(F.sum("trim_ms"), F.lit(0)).cast("bigint").alias("ms"), *gathered)

    def of(*actions: str) -> Column:
        return F.when(F.col("action").isin(*actions), F.col("n")).otherwise(0)

    skipped = F.when((F.col("action") == "skip") & F.col("reason").isNotNull(), F.struct((-F.col("n")).alias("n"), "reason"))
    return counted.groupBy("title_id").agg(
        F.sum("n").alias("total_cues"), F.sum(of("trim")).alias("full_trims"), F.sum(of("partial_trim")).alias("partial_trims"), F.sum(of("skip")).alias("skipped"), F.sum(F.when(cut, F.col("ms")).otherwise(0)).alias("total_trim_ms"),
        F.array_sort(F.collect_list(skipped)).alias("reasons"),  # one for each reason
        *(F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows") for _ in gathered),
    )


def trim_titles(decisions: DataFrame) -> DataFrame:
    """Cues of each title by what trimming did, the time it took off in all and on average, and why cues were left, the most frequent reason first."""
    own = trim_counts(decisions)
    told = F.array_join(F.transform("reasons", lambda r: F.concat(r["reason"], F.lit(": "), (-r["n"]).cast("string"))), ", ")
    return own.withColumn("avg_trim_ms", average(F.col("total_trim_ms"), F.col("full_trims") + F.col("partial_trims"))).withColumn("skip_reasons", told).drop("reasons")


def average(total: Column, n: Column) -> Column:
    """A mean rounded to a whole number, halves to even; null of nothing."""
    return F.when(n > 0, F.bround(total / n)).cast("bigint")


def mappings(drafts: DataFrame, en: DataFrame) -> DataFrame:
    """Cues of both versions and how many have a match, for each title of a draft mapping."""
    own = drafts.groupBy("title_id").agg(F.count("*").alias("nl_cues"), F.count("en_start_ms").alias("matched"))
    source = en.groupBy("title_id").agg(F.count("*").alias("en_cues"))
    return own.join(source, "title_id", "left").select("title_id", "nl_cues", F.coalesce("en_cues", F.lit(0)).alias("en_cues"), "matched", (F.col("nl_cues") - F.col("matched")).alias("unmatched"))


def extensions(cues: DataFrame, extended: DataFrame, listed: Column | None = None) -> DataFrame:
    """Cues, how many were extended, and by how much, for each title. `listed` of each extended cue is gathered in the same pass, in order, as rows."""
    gathered = [] if listed is None else [F.array_sort(F.collect_list(listed)).alias("rows")]
    own = extended.groupBy("title_id").agg(F.count("*").alias("extended_cues"), F.sum("extension_ms").alias("total_extension_ms"), *gathered)
    titles = cues.groupBy("title_id").agg(F.count("*").alias("total_cues")).join(own, "title_id", "left").na.fill(0, ["extended_cues", "total_extension_ms"])
    return titles.withColumn("avg_extension_ms", average(F.col("total_extension_ms"), F.col("extended_cues")))


def alignment(outcomes: DataFrame) -> DataFrame:
    """Cues by what alignment made of them, and figures of the significant corrections, for each title."""
    outcome, moved = F.col("outcome"), F.col("significant")
    deltas = [F.when(moved, F.col(f"{k}_delta_ms")) for k in ("start", "end")]
    own = outcomes.groupBy("title_id").agg(
        F.count("*").alias("total_cues"), *(F.count_if(outcome == o).alias(o) for o in ("aligned", "skipped_short", "skipped_confidence")), F.count_if(moved).alias("significant"),
        *(f(d).alias(f"{k}_{name}") for k, d in zip(("start", "end"), deltas, strict=True) for name, f in (("min", F.min), ("max", F.max), ("sum", F.sum))),
    )
    for k in ("start", "end"):
        own = own.withColumn(f"{k}_avg", average(F.col(f"{k}_sum"), F.col("significant"))).drop(f"{k}_sum")
    return own


def lingering(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cues that linger after speech before and after trimming, and the difference, for each title; of rows as speech.issues has them."""
    both = before.select("title_id", "pos", "type", F.lit(1).alias("b")).unionByName(after.select("title_id", "pos", "type", F.lit(0).alias("b"))).where("type = 'lingers_after_speech'")
    own = both.groupBy("title_id").agg(F.count_if(F.col("b") == 1).alias("before"), F.count_if(F.col("b") == 0).alias("after"))
    return own.withColumn("fixed", F.col("before") - F.col("after"))


def timing_quality(analyzed: DataFrame, found: DataFrame) -> DataFrame:
    """Cues by worst severity, and figures of the distances, for each title."""
    rank = F.when(F.col("severity") == "high", 3).when(F.col("severity") == "medium", 2).otherwise(1)
    worst = found.groupBy("title_id", "pos").agg(F.max(rank).alias("worst"), F.bool_or(F.col("type") == "missing_anticipation").alias("missing"))
    met = analyzed.join(worst, ["title_id", "pos"], "left")
    sd, ed = F.col("start_delta_ms"), F.col("end_delta_ms")
    own = met.groupBy("title_id").agg(
        F.count("*").alias("analyzed"), F.count("worst").alias("flagged"), F.sum(sd).alias("start_delta_sum"), F.min(sd).alias("start_delta_min"), F.max(sd).alias("start_delta_max"), F.count(sd).alias("_starts"), F.count(ed).alias("_ends"),
        F.count_if(F.col("worst") == 3).alias("high"), F.count_if(F.col("worst") == 2).alias("medium"), F.count_if(F.col("worst") == 1).alias("low"), F.sum(ed).alias("end_delta_sum"), F.min(ed).alias("end_delta_min"), F.max(ed).alias("end_delta_max"),
        F.count_if((sd > 0) & (sd <= 200)).alias("ideal"), F.count_if(sd <= 0).alias("without"), F.count_if("missing").alias("missing"),
    )
    own = own.withColumn("start_delta_avg", average(F.col("start_delta_sum"), F.col("_starts"))).withColumn("end_delta_avg", average(F.col("end_delta_sum"), F.col("_ends")))
    return own.drop("_starts", "_ends")


def pair_totals(groups: DataFrame) -> DataFrame:
    """Cues of both versions, their ratio in tenths of a percent, and groups, for each title."""
    own = groups.groupBy("title_id").agg(F.sum("en_count").alias("en_cues"), F.sum("nl_count").alias("nl_cues"), F.count("*").alias("groups"))
    return own.withColumn("ratio_permille", F.coalesce(permille(F.col("nl_cues"), F.col("en_cues")), F.lit(0).cast("bigint")))


def pair_distribution(groups: DataFrame, categories: DataFrame) -> DataFrame:
    """(title_id, kind, name, n, percent, rank): mapping types and categories of each title, the most frequent first, and how many of its groups have them, in percent."""
    kinds = groups.select("title_id", F.lit("mapping").alias("kind"), F.col("merge_type").alias("name"))
    return kind_shares(kinds.unionByName(categories.select("title_id", F.lit("category").alias("kind"), F.col("category").alias("name"))))


def kind_shares(kinds: DataFrame) -> DataFrame:
    """The same of rows (title_id, kind, name), one 'mapping' for each group."""
    own = kinds.groupBy("title_id", "kind", "name").agg(F.count("*").alias("n"))
    of_title = F.sum(F.when(F.col("kind") == "mapping", F.col("n"))).over(Window.partitionBy("title_id"))
    return own.withColumn("percent", F.bround(F.col("n") * 100 / of_title).cast("bigint")).withColumn("rank", F.row_number().over(Window.partitionBy("title_id", "kind").orderBy(F.desc("n"), "name")))


def condensation(groups: DataFrame) -> DataFrame:
    """Mean, upper median, least and greatest ratio of groups with enough text, in millionths."""
    own = groups.where("en_chars > 20 and nl_chars > 0").groupBy("title_id").agg(F.array_sort(F.collect_list("ratio")).alias("r"), F.sum("ratio").alias("s"))
    n = F.size("r")
    return own.select("title_id", n.alias("n"), F.floor(F.col("s") / n).cast("bigint").alias("mean"), F.element_at("r", (F.floor(n / 2) + 1).cast("int")).alias("median"), F.element_at("r", 1).alias("least"), F.element_at("r", -1).alias("greatest"))


def rebalance(cues: DataFrame, soft: int = NL["cps_soft_ceiling"], width: int = 42) -> DataFrame:
    """(title_id, pos, idx, outcome, text, is_high) of flagged two-line cues: 'unbroken', 'fixed', 'skipped_cps' or 'unfixable', with the text after it."""
    return rebalanced(cues, soft, width).where("outcome is not null").select("title_id", "pos", "idx", "outcome", "text", "is_high")


def _two_lines() -> Column:
    return (F.size(T.lines(F.col("text"))) == 2) & ~T.is_dual_speaker(F.col("text"))


def rebalanced(cues: DataFrame, soft: int = NL["cps_soft_ceiling"], width: int = 42) -> DataFrame:
    """All cues with the text after balancing, the outcome, null where nothing was flagged, and is_high. The result may be filtered: nothing that it is made of is worked out twice."""
    parts = T.lines(F.col("text"))
    own = T.once(cues, text=F.col("text"))
    own = T.once(own, _issues=L.balance_issues(F.col("text")), _two=_two_lines(), _top=T.rstrip(F.try_element_at(parts, F.lit(1))), _bottom=T.rstrip(F.try_element_at(parts, F.lit(2))))
    own = T.once(own, _full=F.when(F.col("_two"), F.concat_ws(" ", "_top", "_bottom")))
    # a break is looked for where there is something to mend only
    fits = F.length("_full") <= width
    own = T.once(own, _full=F.when(fits | (F.size("_issues") > 0), F.col("_full")), _fits=fits)
    own = L.with_best_break(own, "_full", "_s", width)
    has = F.col("_s").isNotNull() & ~F.coalesce((F.col("_s.top") == F.col("_top")) & (F.col("_s.bottom") == F.col("_bottom")), F.lit(False))
    duration = F.col("end_ms") - F.col("start_ms")
    chars = T.visible_length(F.col("_s.top")) + T.visible_length(F.col("_s.bottom"))
    own = T.once(own, _has=has, _fast=chars * 1000 > soft * F.when(duration > 0, duration).otherwise(1000))
    has, fast = F.col("_has"), F.col("_fast")
    outcome = F.when(F.col("_full").isNull(), F.lit(None)).when(F.col("_fits"), "unbroken").when(has & fast, "skipped_cps").when(has, "fixed").otherwise("unfixable")
    after = F.when(F.col("_fits"), F.col("_full")).when(has & ~fast, F.concat_ws("\n", "_s.top", "_s.bottom")).otherwise(F.col("text"))
    rest = [c for c in cues.columns if c != "text"]
    return T.once(own.select(*rest, after.alias("text"), outcome.alias("outcome"), F.exists("_issues", lambda i: i["severity"] == "high").alias("is_high")), outcome=F.col("outcome")).select(*rest, "text", "outcome", "is_high")
