"""The validation rules: one row for each hit (title_id, pos, idx, code, severity, line_no, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.operators.timing import NL, by_pos
from cuelake.schema import MAX_DURATION_MS


def violations(cues: DataFrame, limits: dict[str, int] = NL, max_duration: int = MAX_DURATION_MS) -> DataFrame:
    """All rules over a cue and the one before it. A blank cue has one error and no other rule."""
    both = cues.select("title_id", "pos", "idx", "start_ms", "end_ms", "text", *(F.lag(c).over(by_pos()).alias(f"prev_{c}") for c in ("start_ms", "end_ms", "text")))
    text, before = F.col("text"), F.col("prev_text")
    duration = F.col("end_ms") - F.col("start_ms")
    gap = F.col("start_ms") - F.col("prev_end_ms")
    chars = T.char_count(text)
    parts = T.lines(text)
    soft, hard = chars * 1000 > limits["cps_soft_ceiling"] * duration, chars * 1000 > limits["cps_hard_limit"] * duration
    dots = (T.lstrip(text).startswith("...") | T.lstrip(text).startswith("…"), T.rstrip(before).endswith("...") | T.rstrip(before).endswith("…"))
    first = F.substring(T.lstrip(text), 1, 1)
    capital = (F.upper(first) == first) & (F.lower(first) != first)
    clean, clean_before = (F.regexp_replace(F.lower(c), r"(?U)[.\s]", "") for c in (text, before))
    comparable = (clean != "") & (clean_before != "")
    long_enough = comparable & (clean != clean_before) & (F.length(clean) >= 15) & (F.length(clean_before) >= 15)

    def hit(code: str, severity: str, when: Column, value: Column | None = None, line: Column | None = None) -> Column:
        return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (line if line is not None else F.lit(0)).cast("int").alias("line_no"), (value if value is not None else F.lit(0)).cast("bigint").alias("value")))

    blank = T.strip(text) == ""
    numbered = F.arrays_zip(F.sequence(F.lit(1), F.size(parts)).alias("n"), parts.alias("t"))
    too_long = F.transform(numbered, lambda x: hit("line_length", "error", T.visible_length(T.undashed(x["t"])) > limits["max_chars_per_line"], T.visible_length(T.undashed(x["t"])), x["n"]))
    orphans = F.transform(numbered, lambda x: hit("orphan_word", "warning", (F.size(parts) > 1) & T.strip(T.undashed(x["t"])).rlike("^[^ ]{1,5}$"), F.length(T.strip(T.undashed(x["t"]))), x["n"]))
    single = F.array(
        hit("line_count", "error", F.size(parts) > limits["max_lines"], F.size(parts)),
        hit("cps_hard", "error", (duration > 0) & hard, T.micro_cps(text, duration)),
        hit("cps_soft", "warning", (duration > 0) & soft & ~hard, T.micro_cps(text, duration)),
        hit("duration_short", "warning", duration < limits["min_duration_ms"], duration),
        hit("duration_long", "warning", duration > max_duration, duration),
        hit("duration_invalid", "error", duration <= 0, duration),
        hit("overlap", "error", gap < 0, -gap),
        hit("gap_short", "warning", (gap >= 0) & (gap < limits["min_gap_ms"]), gap),
        hit("order", "error", F.col("start_ms") < F.col("prev_start_ms")),
        hit("exclamation", "warning", text.contains("!")),
        hit("semicolon", "error", text.contains(";")),
        hit("smart_ellipsis", "warning", text.contains("…")),
        hit("ellipsis_open", "warning", dots[1] & ~(dots[0] | capital | first.eqNullSafe(F.lit("-")))),
        hit("ellipsis_lone", "warning", dots[0] & before.isNotNull() & ~dots[1]),
        hit("first_dash", "warning", (F.size(parts) == 2) & T.strip(F.try_element_at(parts, F.lit(1))).startswith("-")),
        hit("duplicate", "error", comparable & (clean == clean_before)),
        hit("inside_previous", "error", long_enough & clean_before.contains(clean)),
        hit("contains_previous", "error", long_enough & ~clean_before.contains(clean) & clean.contains(clean_before)),
    )
    every = F.when(blank, F.array(hit("empty", "error", F.lit(True)))).otherwise(F.filter(F.concat(single, too_long, orphans), lambda x: x.isNotNull()))
    found = both.select("title_id", "pos", "idx", F.explode(every).alias("v")).select("title_id", "pos", "idx", "v.code", "v.severity", "v.line_no", "v.value")
    return found.unionByName(_jumps(cues))


def _jumps(cues: DataFrame) -> DataFrame:
    """The first number of each title that isn't its place in the file."""
    placed = cues.select("title_id", "pos", "idx", F.row_number().over(by_pos()).alias("n")).where("idx <> n")
    first = placed.groupBy("title_id").agg(F.min(F.struct("pos", "idx", "n")).alias("f"))
    return first.select("title_id", "f.pos", "f.idx", F.lit("sequence").alias("code"), F.lit("warning").alias("severity"), F.lit(0).alias("line_no"), F.col("f.n").cast("bigint").alias("value"))


def drift_runs(near: DataFrame, warn_ms: int = 3000, error_ms: int = 5000) -> DataFrame:
    """Runs of consecutive numbers whose starts are off by warn_ms or more: (title_id, first_idx, last_idx, n_cues, max_deviation_ms, severity) for rows (title_id, pos, idx, distance_ms)."""
    off = near.where(F.col("distance_ms") >= warn_ms)
    order = Window.partitionBy("title_id").orderBy("pos")
    runs = off.withColumn("_run", F.col("idx") - F.row_number().over(order)).groupBy("title_id", "_run").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.max("distance_ms").alias("max_deviation_ms"))
    n = F.col("last_idx") - F.col("first_idx") + 1
    return runs.select("title_id", "first_idx", "last_idx", n.cast("int").alias("n_cues"), "max_deviation_ms", F.when((F.col("max_deviation_ms") >= error_ms) & (n > 1), "error").otherwise("warning").alias("severity"))
