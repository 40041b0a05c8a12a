"""What a draft goes through until it is finished: each step takes what the one before it made.

Structural fixes, merging, trimming to speech, closing gaps and giving fast cues time, numbers
and credit, line balance. Trimmed ends go on into the extensions, and what is extended is what is
balanced and judged. All steps are windows over a title, and columns are carried along
rather than joined back, so a title is dealt once and no step is worked out twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.operators import merge, rules, speech, stats, timing
from cuelake.operators.timing import NL


def finish(draft: DataFrame, spoken: DataFrame, credit: str, gap_threshold_ms: int = 1000, max_duration_ms: int | None = None, limits: dict[str, int] = NL) -> DataFrame:
    """(title_id, pos, idx, start_ms, end_ms, text, source_count, trim_ms, closed, extended, balance): finished cues of a draft (title_id, pos, idx, start_ms, end_ms, text with markers), with what became of each.

    `spoken` is speech as speech.segments has it. source_count is null for the credit, trim_ms 0 for a cue that was not trimmed,
    balance null for one that was not flagged. A title without speech is not trimmed. Limits are those of a language and
    framerate; gap and duration of merging are the genre's. Blank cues go; a title of nothing else has no rows.
    """
    longest, min_gap = limits["max_duration_ms"], limits["min_gap_ms"]
    merged = merge.merge_cues(timing.fix_srt(draft, min_gap), gap_threshold_ms, max_duration_ms or longest).withColumn("pos", F.col("idx").cast("bigint"))
    decided = speech.trim(
        merged, spoken, soft=limits["cps_soft_ceiling"], hard=limits["cps_hard_limit"], min_duration=limits["min_duration_ms"], min_gap=min_gap, keep=("start_ms", "text", "source_count")
    )
    ended = decided.withColumn("end_ms", F.coalesce("new_end_ms", "old_end_ms")).select("title_id", "pos", "idx", "start_ms", "end_ms", "text", "source_count", "trim_ms")
    timed = timing.extend_cps(timing.close_gaps(ended, min_gap=min_gap, max_duration=longest), min_gap=min_gap, max_duration=longest)
    balanced = stats.rebalanced(timing.add_credit(timed, credit), limits["cps_soft_ceiling"], limits["max_chars_per_line"])
    return balanced.select("title_id", "pos", "idx", "start_ms", "end_ms", "text", "source_count", "trim_ms", "closed", "extended", F.col("outcome").alias("balance"))


def summary(finished: DataFrame, limits: dict[str, int] = NL) -> DataFrame:
    """What finishing did to each title, and the errors and warnings that its result still has. `finished` is used twice: hand it over written."""
    made = F.col("source_count")
    own = finished.groupBy("title_id").agg(
        F.sum(made).alias("source_cues"), F.count(made).alias("output_cues"), F.count_if(made > 1).alias("merges"), F.count_if(F.col("trim_ms") > 0).alias("trimmed"), F.sum("trim_ms").alias("total_trim_ms"),
        *(F.count_if(c).alias(c) for c in ("closed", "extended")), F.count_if(F.col("balance").isin("unbroken", "fixed")).alias("rebalanced"),
    )
    own = own.withColumn("ratio_permille", stats.permille(F.col("output_cues"), F.col("source_cues")))
    return own.join(stats.summary(finished, rules.violations(finished, limits, limits["max_duration_ms"])), "title_id")
