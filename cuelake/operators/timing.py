"""Rewriters of cue times. Each reads its neighbours' starts only, so one window does it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.schema import limits

NL = limits("nl", 25)


def by_pos() -> WindowSpec:
    """Cues of a title in file order."""
    return Window.partitionBy("title_id").orderBy("pos")


def following(column: str = "start_ms") -> Column:
    return F.lead(column).over(by_pos())


def gaps(cues: DataFrame) -> DataFrame:
    return cues.withColumn("gap_ms", F.col("start_ms") - F.lag("end_ms").over(by_pos()))


def renumber(cues: DataFrame) -> DataFrame:
    """Numbers from 1 in file order; old_idx is the number before."""
    return cues.withColumn("old_idx", F.col("idx")).withColumn("idx", F.row_number().over(by_pos()))


def reorder(cues: DataFrame) -> DataFrame:
    """Stable order by start; moved says whether a cue changed its place."""
    by_start = Window.partitionBy("title_id").orderBy("start_ms", "pos")
    placed = cues.withColumn("_new", F.row_number().over(by_start).cast("bigint")).withColumn("_old", F.row_number().over(by_pos()).cast("bigint"))
    return placed.withColumn("moved", F.col("_new") != F.col("_old")).withColumn("pos", F.col("_new")).drop("_new", "_old")


def fix_overlap(cues: DataFrame, min_gap: int = NL["min_gap_ms"]) -> DataFrame:
    """Ends a cue earlier where the next one starts within min_gap. A cue that would get no duration stays, and is flagged; fixed_by has the next cue's number."""
    after = following()
    close = after - F.col("end_ms") < min_gap
    end = F.greatest(F.lit(0).cast("bigint"), after - min_gap)
    can = close & (end > F.col("start_ms"))
    return (
        cues.withColumn("fixed_by", F.when(close, following("idx")))
        .withColumn("unfixable", F.coalesce(close & ~can, F.lit(False)))
        .withColumn("new_end_ms", F.when(can, end).otherwise(F.col("end_ms")))
    )


def close_gaps(cues: DataFrame, close: int = 1000, min_gap: int = NL["min_gap_ms"], max_duration: int = NL["max_duration_ms"]) -> DataFrame:
    """Extends a cue to the next one if the gap is small."""
    after, end = following(), following() - min_gap
    gap = after - F.col("end_ms")
    can = (gap > 0) & (gap < close) & (end > F.col("end_ms")) & (end - F.col("start_ms") <= max_duration)
    return cues.withColumn("closed", F.coalesce(can, F.lit(False))).withColumn("end_ms", F.when(can, end).otherwise(F.col("end_ms")))


def needed_ms(chars: Column, rate: float) -> Column:
    return (chars / F.lit(float(rate)) * 1000).cast("bigint")


def extend_cps(cues: DataFrame, target: float = 12.5, threshold: float = 13.0, min_gap: int = NL["min_gap_ms"], max_duration: int = NL["max_duration_ms"]) -> DataFrame:
    """Gives fast cues the time they need, as far as the next cue lets them."""
    start, end, after = F.col("start_ms"), F.col("end_ms"), following()
    duration, chars = end - start, T.char_count(F.col("text"))
    fast = F.when(duration > 0, chars * 1000.0 / duration > threshold).otherwise(F.lit(True))
    need = needed_ms(chars, target)
    inside = F.when(after - end > min_gap, F.least(F.least(start + need, after - min_gap), start + max_duration))
    new_end = F.when(after.isNull(), start + F.least(need, F.lit(max_duration).cast("bigint"))).otherwise(inside)
    can = F.coalesce(fast & (new_end > end), F.lit(False))
    return cues.withColumn("extended", can).withColumn("end_ms", F.when(can, new_end).otherwise(end))


def shift(cues: DataFrame, offset_ms: int, first: int | None = None, last: int | None = None) -> DataFrame:
    """Moves all cues, or those numbered first to last."""
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col("idx") >= first)
    if last is not None:
        inside = inside & (F.col("idx") <= last)
    moved = F.when(inside, offset_ms).otherwise(0)
    return cues.withColumn("start_ms", F.col("start_ms") + moved).withColumn("end_ms", F.col("end_ms") + moved)


def add_credit(cues: DataFrame, credit: str, gap_ms: int = 3000, duration_ms: int = 3000, rate: float | None = None) -> DataFrame:
    """A last cue with the credit for each title whose last cue doesn't have it; columns beyond those of cues are null in it."""
    length = int(len(credit) / rate * 1000) if rate else duration_ms
    own = cues.withColumn("_n", F.row_number().over(by_pos())).withColumn("_last", following("pos").isNull())
    due = F.col("_last") & ~F.lower("text").contains(credit.lower())
    own = own.withColumn("_added", F.explode(F.when(due, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    start = F.col("end_ms") + gap_ms
    new = {"pos": F.col("pos") + 1, "idx": F.col("_n") + 1, "start_ms": start, "end_ms": start + length, "text": F.lit(credit)}
    return own.select("title_id", *(F.when(F.col("_added"), new.get(c, F.lit(None))).otherwise(F.col(c)).alias(c) for c in cues.columns if c != "title_id"))


def fix_srt(cues: DataFrame, min_gap: int = NL["min_gap_ms"]) -> DataFrame:
    """The structural fix: blank cues go, order by start, texts, overlaps, numbers."""
    kept = cues.where(T.strip(F.col("text")) != "")
    placed = reorder(kept)
    # step by step: each step refers to its text many times
    for n, step in enumerate((lambda c: T.fix_ellipsis(T.fix_punctuation(c)), T.fix_line_length, T.fix_speaker_dash)):
        placed = placed.withColumn("fixed_text", step(F.col("fixed_text" if n else "text")))
    fixed = fix_overlap(placed, min_gap)
    return fixed.select("title_id", "pos", F.row_number().over(by_pos()).alias("idx"), F.col("idx").alias("old_idx"), "start_ms", F.col("new_end_ms").alias("end_ms"), F.col("fixed_text").alias("text"), F.col("text").alias("original_text"), "moved", "unfixable")


def unfixable(cues: DataFrame) -> DataFrame:
    """Cues that are still over a hard limit: reading speed, number of lines, line length."""
    duration = F.col("end_ms") - F.col("start_ms")
    long = F.exists(T.lines(F.col("text")), lambda x: T.visible_length(T.undashed(x)) > NL["max_chars_per_line"])
    fast = F.coalesce(T.cps(F.col("text"), duration) > NL["cps_hard_limit"], F.lit(False))
    return cues.where(fast | (F.size(T.lines(F.col("text"))) > NL["max_lines"]) | long)


def apply_alignment(cues: DataFrame, corrections: DataFrame, end_padding: int = 200) -> DataFrame:
    """Significant corrections (title_id, idx, aligned_start_ms, aligned_end_ms) replace times; then overlaps and empty durations are mended."""
    met = cues.join(corrections.select("title_id", "idx", "aligned_start_ms", "aligned_end_ms"), ["title_id", "idx"], "left")
    moved = met.withColumn("applied", F.col("aligned_start_ms").isNotNull())
    moved = moved.withColumn("start_ms", F.coalesce("aligned_start_ms", "start_ms")).withColumn("end_ms", F.coalesce(F.col("aligned_end_ms") + end_padding, F.col("end_ms")))
    after = following()
    moved = moved.withColumn("end_ms", F.when(F.col("end_ms") > after, after - 1).otherwise(F.col("end_ms")))
    return moved.withColumn("end_ms", F.when(F.col("end_ms") <= F.col("start_ms"), F.col("start_ms") + 500).otherwise(F.col("end_ms"))).drop("aligned_start_ms", "aligned_end_ms")


def alignment_outcomes(segments: DataFrame, cues: DataFrame, padding: int = 1500, min_confidence: float = 0.5, threshold: int = 150) -> DataFrame:
    """What word segments (title_id, idx, word_no, start_frame, end_frame; 10 ms frames from the start of the cue's window) make of each cue.

    outcome is 'skipped_short' for a cue of under two words, one of which nothing was heard, or one that would move by over twice the padding;
    'skipped_confidence' where too few words were heard; else 'aligned'. `confidence` in thousandths.
    """
    before = F.lag("end_ms").over(by_pos())
    back = F.when(before < F.col("start_ms"), F.least(F.floor((F.col("start_ms") - before) / 2), F.lit(padding))).otherwise(padding)
    framed = cues.withColumn("window_start_ms", F.greatest(F.lit(0), F.col("start_ms") - back).cast("bigint")).withColumn("words_expected", F.size(T.words(F.col("text"))))
    found = segments.groupBy("title_id", "idx").agg(F.min_by("start_frame", "word_no").alias("first"), F.max_by("end_frame", "word_no").alias("last"), F.count("*").alias("words_found"))
    met = framed.join(found, ["title_id", "idx"], "left")
    met = met.withColumn("aligned_start_ms", F.col("window_start_ms") + F.col("first") * 10).withColumn("aligned_end_ms", F.col("window_start_ms") + F.col("last") * 10)
    met = met.withColumn("start_delta_ms", F.col("aligned_start_ms") - F.col("start_ms")).withColumn("end_delta_ms", F.col("aligned_end_ms") - F.col("end_ms"))
    met = met.withColumn("confidence", F.floor(F.col("words_found") * 1000 / F.col("words_expected")).cast("bigint"))
    none = (F.col("words_expected") < 2) | F.col("words_found").isNull() | (F.abs("start_delta_ms") > 2 * padding)
    outcome = F.when(none, "skipped_short").when(F.col("words_found") < min_confidence * F.col("words_expected"), "skipped_confidence").otherwise("aligned")
    far = (F.abs("start_delta_ms") > threshold) | (F.abs("end_delta_ms") > threshold)
    met = met.withColumn("outcome", outcome).withColumn("significant", (F.col("outcome") == "aligned") & F.coalesce(far, F.lit(False)))
    return met.select("title_id", "idx", "aligned_start_ms", "aligned_end_ms", "start_delta_ms", "end_delta_ms", "words_expected", "words_found", "confidence", "significant", "outcome")


def significant_corrections(segments: DataFrame, cues: DataFrame, padding: int = 1500, min_confidence: float = 0.5) -> DataFrame:
    """The corrections of cues that were aligned."""
    return alignment_outcomes(segments, cues, padding, min_confidence).where("outcome = 'aligned'").drop("outcome")
