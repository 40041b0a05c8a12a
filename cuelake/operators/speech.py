"""Speech activity: smoothing, segments, and timing of cues against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import text as T
from cuelake.operators import asof
from cuelake.operators.timing import NL, by_pos, following
from cuelake.schema import FRAME_MS


#: Frames in a word of bits.
WORD = 60


def _pieces(frames: DataFrame) -> DataFrame:
    """(title_id, is_speech, first_frame, end_frame): stretches of equal frames within words of bits. Frames are summed as bits, so that none is sorted; one without a value is a stretch of its own."""
    at, heard = F.col("frame_idx"), F.col("is_speech")
    bit = F.expr(f"shiftleft(1L, cast(pmod(frame_idx, {WORD}) as int))")
    values = {"_s": (heard, True), "_n": (~heard, False), "_z": (heard.isNull(), None)}
    words = frames.groupBy("title_id", F.floor(at / WORD).alias("_w")).agg(*(F.coalesce(F.bit_or(F.when(when, bit)), F.lit(0).cast("bigint")).alias(c) for c, (when, _) in values.items()))

    def places(mask: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(mask, i) == 1)

    def stretches(c: str, value: bool | None) -> Column:
        mask, base, known = F.col(c), F.col("_w") * WORD, value is not None
        first = mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1))) if known else mask
        last = mask.bitwiseAND(F.bitwise_not(F.shiftright(mask, 1))) if known else mask
        found = F.zip_with(places(first), places(last), lambda a, b: F.struct(F.lit(value).cast("boolean").alias("is_speech"), (base + a).alias("first_frame"), (base + b + 1).alias("end_frame")))
        return F.when(mask != 0, found).otherwise(F.array().cast("array<struct<is_speech: boolean, first_frame: bigint, end_frame: bigint>>"))

    return words.select("title_id", F.inline(F.concat(*(stretches(c, value) for c, (_, value) in values.items()))))


def runs(frames: DataFrame) -> DataFrame:
    """(title_id, run_no, is_speech, first_frame, end_frame): runs of equal frames; everything after works on these, a hundredth of the rows."""
    in_order = Window.partitionBy("title_id").orderBy("first_frame", "is_speech")
    flips = (F.col("is_speech") != F.lag("is_speech").over(in_order)).cast("int")
    numbered = _pieces(frames).withColumn("run_no", F.sum(F.coalesce(flips, F.lit(1))).over(in_order))
    return numbered.groupBy("title_id", "run_no", "is_speech").agg(F.min("first_frame").alias("first_frame"), F.max("end_frame").alias("end_frame"))


def smooth(frames: DataFrame, hangover: int = 7) -> DataFrame:
    """Runs with silences of at most `hangover` frames between speech filled; leading and trailing silence stays."""
    return smooth_runs(runs(frames), hangover)


def smooth_runs(found: DataFrame, hangover: int = 7) -> DataFrame:
    """smooth, of runs that are there already."""
    order = Window.partitionBy("title_id").orderBy("run_no")
    between = F.lag("run_no").over(order).isNotNull() & F.lead("run_no").over(order).isNotNull()
    filled = found.withColumn("is_speech", F.col("is_speech") | (between & (F.col("end_frame") - F.col("first_frame") <= hangover)))
    flips = (F.col("is_speech") != F.lag("is_speech").over(order)).cast("int")
    filled = filled.withColumn("n", F.sum(F.coalesce(flips, F.lit(1))).over(order))
    return filled.groupBy("title_id", "n", "is_speech").agg(F.min("first_frame").alias("first_frame"), F.max("end_frame").alias("end_frame")).withColumnRenamed("n", "run_no")


def segments(smoothed: DataFrame, frame_ms: int = FRAME_MS) -> DataFrame:
    """(title_id, seg_no, start_ms, end_ms) of speech."""
    spoken = smoothed.where("is_speech")
    number = F.row_number().over(Window.partitionBy("title_id").orderBy("first_frame")).cast("bigint")
    return spoken.select("title_id", number.alias("seg_no"), (F.col("first_frame") * frame_ms).alias("start_ms"), (F.col("end_frame") * frame_ms).alias("end_ms"))


def trim(cues: DataFrame, spoken: DataFrame, search_range: int = 2000, buffer: int = 250, min_trim: int = 400, soft: int = NL["cps_soft_ceiling"], hard: int = NL["cps_hard_limit"], min_duration: int = NL["min_duration_ms"], min_gap: int = NL["min_gap_ms"], keep: tuple[str, ...] = ()) -> DataFrame:
    """(title_id, pos, idx, old_end_ms, action, reason, new_end_ms, trim_ms, method): a cue that lingers after speech ends sooner, as far as reading speed, duration and the gap after it allow. `keep` columns of cues come along."""
    own = cues.select("title_id", "pos", "idx", "start_ms", "end_ms", T.char_count(F.col("text")).alias("chars"), (following() - min_gap).alias("latest"), *(c for c in keep if c != "start_ms"))
    met = asof.nearest(own, spoken.select("title_id", F.col("end_ms").alias("speech_end")), "end_ms", "speech_end", within=search_range)
    start, end, near, latest, chars = (F.col(c) for c in ("start_ms", "end_ms", "nearest_ms", "latest", "chars"))
    wanted = near + buffer
    clamped = F.least(wanted, F.coalesce(latest, wanted))
    duration = clamped - start
    calm = chars * 1000 <= soft * duration
    target = start + (chars / F.lit(float(soft)) * 1000).cast("bigint")
    part = F.least(target, F.coalesce(latest, target))
    reason = (
        F.when(near.isNull(), "no_transition")
        .when(near > end, "speech_extends_past_cue")
        .when(end - near < min_trim, "below_min_trim")
        .when(wanted >= end, "buffer_exceeds_current_end")
        .when(wanted - start < min_duration, "min_duration")
        .when(duration < min_duration, "min_duration_after_gap_clamp")
        .when(duration <= 0, "zero_duration")
        .when(calm, F.lit(None))
        .when(target >= end, F.when(chars * 1000 > hard * duration, "cps_hard_limit").otherwise("cps_soft_ceiling"))
        .when(end - target < min_trim, "partial_trim_too_small")
        .when(part - start < min_duration, "min_duration_partial")
    )
    new_end = F.when(reason.isNull(), F.when(calm, clamped).otherwise(part))
    out = met.withColumn("reason", reason).withColumn("new_end_ms", new_end).withColumn("method", F.when(reason.isNull(), F.when(calm, "full").otherwise("partial")))
    action = F.when(F.col("method") == "full", "trim").when(F.col("method") == "partial", "partial_trim").otherwise("skip")
    return out.select("title_id", "pos", "idx", F.col("end_ms").alias("old_end_ms"), action.alias("action"), "reason", "new_end_ms", F.coalesce(end - F.col("new_end_ms"), F.lit(0)).alias("trim_ms"), "method", *keep)


def trimmed(cues: DataFrame, decisions: DataFrame) -> DataFrame:
    """cues with the ends that trim decided."""
    own = cues.join(decisions.where("new_end_ms is not null").select("title_id", "pos", F.col("new_end_ms").alias("_end")), ["title_id", "pos"], "left")
    return own.withColumn("end_ms", F.coalesce("_end", "end_ms")).select(*cues.columns)


def extend(cues: DataFrame, frames: DataFrame, search: int = 3000, min_gap: int = 125, most: int = 3000, silence: int = 10) -> DataFrame:
    """(title_id, pos, idx, old_end_ms, new_end_ms, extension_ms): cues extended to where speech ends after them.

    Frames are looked at as runs: the scan of a cue goes from its start to the end of its search range, and stops at the first silent frame after its end that makes `silence` in a row; a silence counts from where the scan or the silence began.
    """
    return extend_along(cues, runs(frames), search, min_gap, most, silence)


def extend_along(cues: DataFrame, found: DataFrame, search: int = 3000, min_gap: int = 125, most: int = 3000, silence: int = 10) -> DataFrame:
    """extend, along runs that are there already."""
    end = F.col("end_ms")
    limit = F.least(F.coalesce(following() - min_gap, end + most), end + most)
    own = cues.select("title_id", "pos", "idx", "start_ms", "end_ms", limit.alias("max_end")).where("max_end > end_ms and start_ms >= 0")
    own = own.withColumn("lo", F.floor(F.col("start_ms") / FRAME_MS)).withColumn("until", end + F.least(F.lit(search), F.col("max_end") - end + 500)).withColumn("hi", F.floor(F.col("until") / FRAME_MS))
    spans = found.select("title_id", "is_speech", (F.col("first_frame") * FRAME_MS).alias("start_ms"), (F.col("end_frame") * FRAME_MS).alias("end_ms"))
    scan = own.where("hi > lo").select("title_id", "pos", "idx", F.col("end_ms").alias("cue_end"), "max_end", "lo", "hi", (F.col("lo") * FRAME_MS).alias("start_ms"), (F.col("hi") * FRAME_MS).alias("end_ms"))
    met = asof.overlapping(scan, spans)
    a = F.greatest(F.col("lo"), F.floor(F.col("p_start_ms") / FRAME_MS))
    b = F.least(F.col("hi"), F.floor(F.col("p_end_ms") / FRAME_MS))
    # first frame of the run that is after the cue's end and makes enough silence
    stop = F.greatest(F.floor(F.col("cue_end") / FRAME_MS) + 1, a + silence - 1)
    met = met.withColumn("a", a).withColumn("b", b).withColumn("stop", F.when(~F.col("p_is_speech") & (stop < b), stop))
    key = ["title_id", "pos", "idx", "cue_end", "max_end"]
    stops = met.groupBy(*key).agg(F.min("stop").alias("stop"), F.collect_list(F.when(F.col("p_is_speech"), F.col("b"))).alias("ends"))
    last = F.array_max(F.filter("ends", lambda e: F.col("stop").isNull() | (e <= F.col("stop"))))
    speech_end = F.greatest(F.coalesce(last * FRAME_MS, F.lit(0)), F.col("cue_end"))
    out = stops.withColumn("speech_end", speech_end).where("speech_end > cue_end").withColumn("new_end_ms", F.least(F.col("speech_end") + 100, F.col("max_end")))
    return out.withColumn("extension_ms", F.col("new_end_ms") - F.col("cue_end")).where("extension_ms > 50").select("title_id", "pos", "idx", F.col("cue_end").alias("old_end_ms"), "new_end_ms", "extension_ms")


def analyze(cues: DataFrame, en: DataFrame, matches: DataFrame, spoken: DataFrame, search_range: int = 2000) -> DataFrame:
    """Each cue with the nearest speech end and start, the distances, and the times of its matches."""
    met = matches.join(en.select("title_id", F.col("pos").alias("en_pos"), F.col("start_ms").alias("s"), F.col("end_ms").alias("e")), ["title_id", "en_pos"])
    source = met.groupBy("title_id", F.col("nl_pos").alias("pos")).agg(F.min_by("s", "en_pos").alias("en_start"), F.max_by("e", "en_pos").alias("en_end"))
    own = cues.select("title_id", "pos", "idx", F.col("start_ms").alias("nl_start"), F.col("end_ms").alias("nl_end"), F.lag("end_ms").over(by_pos()).alias("prev_end"), F.lead("start_ms").over(by_pos()).alias("next_start"))
    # ends among ends and starts among starts, both in one pass over the speech
    asked = own.withColumn("_a", F.explode(F.array(F.struct(F.lit("end").alias("side"), F.col("nl_end").alias("at")), F.struct(F.lit("start").alias("side"), F.col("nl_start").alias("at")))))
    heard = spoken.select("title_id", F.explode(F.array(F.struct(F.lit("end").alias("side"), F.col("end_ms").alias("t")), F.struct(F.lit("start").alias("side"), F.col("start_ms").alias("t")))).alias("_h"))
    asked = asked.select(F.struct("title_id", "_a.side").alias("_k"), F.col("_a.at").alias("at"), *[c for c in own.columns if c != "title_id"])
    met = asof.nearest(asked, heard.select(F.struct("title_id", "_h.side").alias("_k"), "_h.t"), "at", "t", key="_k", within=search_range)
    sides = [F.max(F.when(F.col("_k.side") == side, F.col("nearest_ms"))).alias(f"speech_{side}") for side in ("end", "start")]
    own = met.groupBy(F.col("_k.title_id").alias("title_id"), *[c for c in own.columns if c != "title_id"]).agg(*sides)
    own = own.join(source, ["title_id", "pos"], "left")
    return own.select(
        "title_id", "pos", "idx", "nl_start", "nl_end", "en_start", "en_end", "speech_end", "speech_start", (F.col("speech_end") - F.col("nl_end")).alias("end_delta_ms"), (F.col("speech_start") - F.col("nl_start")).alias("start_delta_ms"),
        F.when(F.col("en_end") != 0, F.col("nl_end") - F.col("en_end")).alias("nl_end_vs_en"), "prev_end", "next_start",
    )


def issues(analyzed: DataFrame, threshold: int = 500) -> DataFrame:
    """(title_id, pos, idx, type, severity): one row for each timing issue."""
    ed, sd = F.col("end_delta_ms"), F.col("start_delta_ms")
    same_end = F.coalesce(F.abs(F.col("nl_end") - F.col("en_end")) <= 200, F.lit(False))
    same_start = F.coalesce(F.abs(F.col("nl_start") - F.col("en_start")) <= 200, F.lit(False))
    followed = F.coalesce((F.col("next_start") <= F.col("speech_end")) | (F.col("next_start") - F.col("nl_end") <= 200), F.lit(False))
    preceded = F.coalesce(F.col("prev_end") >= F.col("nl_start") - 200, F.lit(False))

    def issue(kind: str, when: Column, severity: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("type"), severity.alias("severity")))

    def grade(inherited: Column, bad: Column) -> Column:
        return F.when(inherited, "low").when(bad, "high").otherwise("medium")

    found = F.array(
        issue("cuts_off_during_speech", (ed > threshold) & ~followed, grade(same_end, ed > 1000)),
        issue("lingers_after_speech", ed < -threshold, grade(same_end, ed < -1500)),
        issue("late_start", (sd < -threshold) & ~preceded, grade(same_start, sd < -1000)),
        issue("early_start", sd > 1500, F.lit("low")),
        issue("missing_anticipation", (sd >= -threshold) & (sd <= 0) & ~preceded, grade(same_start, F.lit(False))),
    )
    return analyzed.select("title_id", "pos", "idx", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select("title_id", "pos", "idx", "i.type", "i.severity")
