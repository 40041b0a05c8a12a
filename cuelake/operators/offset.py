"""One offset for each title: by how much its cues come too early or too late against its speech.

1. Votes. Each difference between the start of a cue and the start of a stretch of speech
   within `reach` is a vote; votes are counted by steps of `step`. Cues and speech meet in
   blocks of time, so that a long title is dealt like many short ones, and votes are
   summed before they are shuffled. The steps with most votes are candidates.
2. Cross-correlation. How long moved cues and speech overlap is a function of the offset
   that bends only where an end of a cue meets an end of speech. For each candidate the
   bends near it are summed by offset; running sums of them give the function exactly, to
   the millisecond. The offset with the longest overlap counts, then the smaller move.

A title has at most a bend for each millisecond near its candidates. All is integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest offset looked for, width of a step of votes, how far around a candidate is looked, and how many candidates a title has.
REACH_MS, STEP_MS, AROUND_MS, CANDIDATES = 60_000, 200, 600, 3


def _meet(cues: DataFrame, spoken: DataFrame, reach: int) -> DataFrame:
    """Cues with the stretches of speech of their title that begin within `reach`; ce and se are ends, cs and ss starts."""
    block = F.floor(F.col("cs") / reach)
    own = cues.select("title_id", F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce")).withColumn("block", block)
    other = spoken.select("title_id", F.col("start_ms").alias("ss"), F.col("end_ms").alias("se")).withColumn("block", F.explode(F.array(*[F.floor(F.col("ss") / reach) + k for k in (-1, 0, 1)])))
    return own.join(other, ["title_id", "block"]).where(F.abs(F.col("ss") - F.col("cs")) <= reach)


def votes(cues: DataFrame, spoken: DataFrame, reach: int = REACH_MS, step: int = STEP_MS) -> DataFrame:
    """(title_id, bin, n): how many pairs of a cue and a stretch of speech begin bin * step to (bin + 1) * step ms apart."""
    return _meet(cues, spoken, reach).groupBy("title_id", F.floor((F.col("ss") - F.col("cs")) / step).alias("bin")).agg(F.count("*").alias("n"))


def _first(partition: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def offsets(cues: DataFrame, spoken: DataFrame, reach: int = REACH_MS, step: int = STEP_MS, around: int = AROUND_MS, candidates: int = CANDIDATES) -> DataFrame:
    """(title_id, offset_ms, overlap_ms, score, votes) for each title with cues and speech within reach: moving its cues by offset_ms lets them overlap speech for overlap_ms, `score` thousandths of what they last; votes of the step that led there."""
    counted = votes(cues, spoken, reach, step)
    best = counted.withColumn("_r", _first(["title_id"], F.desc("n"), F.abs("bin"), F.col("bin"))).where(F.col("_r") <= candidates)
    best = best.select("title_id", "bin", F.col("n").alias("votes"), (F.col("bin") * step - around).alias("lo"), (F.col("bin") * step + around).alias("hi"))
    # what a candidate's window can reach begins at most `around` and the longer of the two later
    met = _overlapping(cues, spoken, best)
    rise, fall = F.col("ss") - F.col("ce"), F.col("se") - F.col("cs")
    inner = (F.least(F.col("ss") - F.col("cs"), F.col("se") - F.col("ce")), F.greatest(F.col("ss") - F.col("cs"), F.col("se") - F.col("ce")))
    bends = F.array(*[F.struct(F.least(F.greatest(at, F.col("lo")), F.col("hi")).alias("at"), F.lit(by).alias("by"), at.alias("own")) for at, by in ((rise, 1), (inner[0], -1), (inner[1], -1), (fall, 1))])
    # overlap at the window's left edge, and how it bends within; a bend before the edge only adds to the slope there
    edge = F.greatest(F.lit(0), F.least(F.col("ce") + F.col("lo"), F.col("se")) - F.greatest(F.col("cs") + F.col("lo"), F.col("ss")))
    key = ["title_id", "bin", "lo", "hi", "votes"]
    at_edge = met.groupBy(*key).agg(F.sum(edge).alias("begin"))
    summed = met.select(*key, F.explode(bends).alias("b")).where("b.own < hi").groupBy(*key, F.col("b.at").alias("at")).agg(F.sum("b.by").cast("bigint").alias("by"))
    edges = at_edge.select(*key, F.col("lo").alias("at"), F.lit(0).cast("bigint").alias("by"))
    ends = at_edge.select(*key, F.col("hi").alias("at"), F.lit(0).cast("bigint").alias("by"))
    points = summed.unionByName(edges).unionByName(ends).groupBy(*key, "at").agg(F.sum("by").alias("by"))
    along = Window.partitionBy("title_id", "bin").orderBy("at")
    points = points.withColumn("slope", F.sum("by").over(along)).withColumn("_gap", F.col("at") - F.lag("at").over(along)).withColumn("_before", F.lag("slope").over(along))
    value = F.coalesce(F.sum(F.col("_gap") * F.col("_before")).over(along), F.lit(0))
    curve = points.withColumn("rise", value).join(at_edge.select("title_id", "bin", "begin"), ["title_id", "bin"]).withColumn("overlap_ms", F.col("begin") + F.col("rise"))
    top = curve.withColumn("_r", _first(["title_id"], F.desc("overlap_ms"), F.abs("at"), F.col("at"), F.desc("votes"), F.abs("bin"), F.col("bin"))).where("_r = 1")
    lasts = cues.groupBy("title_id").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("lasts"))
    return top.join(lasts, "title_id").select(
        "title_id", F.col("at").alias("offset_ms"), F.col("overlap_ms").cast("bigint"), F.when(F.col("lasts") > 0, F.floor(F.col("overlap_ms") * 1000 / F.col("lasts"))).cast("bigint").alias("score"), "votes"
    )


def _overlapping(cues: DataFrame, spoken: DataFrame, best: DataFrame) -> DataFrame:
    """Cues and stretches of speech that overlap somewhere in a candidate's window: cues moved to its middle meet speech in blocks of time that both last through."""
    block, around = 10_000, (F.col("hi") - F.col("lo")) / 2
    middle = ((F.col("lo") + F.col("hi")) / 2).cast("bigint")
    own = cues.select("title_id", F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce")).join(best, "title_id")  # a few candidates a title
    own = own.withColumn("_a", F.floor((F.col("cs") + middle - around) / block)).withColumn("_b", F.floor((F.col("ce") + middle + around) / block))
    own = own.withColumn("block", F.explode(F.sequence("_a", F.greatest("_a", "_b"))))
    other = spoken.select("title_id", F.col("start_ms").alias("ss"), F.col("end_ms").alias("se"))
    other = other.withColumn("_c", F.floor(F.col("ss") / block)).withColumn("block", F.explode(F.sequence("_c", F.greatest(F.col("_c"), F.floor(F.col("se") / block)))))
    met = own.join(other, ["title_id", "block"]).where((F.col("cs") + F.col("lo") < F.col("se")) & (F.col("ce") + F.col("hi") > F.col("ss")))
    # of the blocks that they share the first one counts
    return met.where(F.col("block") == F.greatest("_a", "_c")).drop("_a", "_b", "_c", "block")


def apply(cues: DataFrame, found: DataFrame, least_score: int = 0) -> DataFrame:
    """Cues moved by their title's offset, where its score is `least_score` or more; others stay. Times don't go below 0."""
    moved = cues.join(found.where(F.col("score") >= least_score).select("title_id", "offset_ms"), "title_id", "left").withColumn("offset_ms", F.coalesce("offset_ms", F.lit(0).cast("bigint")))
    return moved.withColumn("start_ms", F.greatest(F.lit(0).cast("bigint"), F.col("start_ms") + F.col("offset_ms"))).withColumn("end_ms", F.greatest(F.lit(0).cast("bigint"), F.col("end_ms") + F.col("offset_ms")))
