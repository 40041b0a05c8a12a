"""Nearest-time joins and interval joins that never compare all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds of a time bucket.
BUCKET_MS = 10_000


def nearest(left: DataFrame, right: DataFrame, at: str, moment: str, key: str = "title_id", within: int | None = None, keep: list[str] = ()) -> DataFrame:
    """left with nearest_ms and distance_ms: the moment of `right` with the same key that is nearest to left's `at`; ties go to the earlier; null beyond `within`.

    Both sides are dealt together once and sorted twice, forwards and backwards: the last moment
    before and the first after each row are carried by windows, so the cost doesn't grow with the distance. `keep`
    columns of `right` come along, of the smallest such row of the moment.
    """
    carried = [F.col(c) for c in keep]
    moments = right.groupBy(key, F.col(moment).alias("_t")).agg(*(F.min(F.struct(*carried)).alias("_k") for _ in [0] if keep)) if keep else right.select(key, F.col(moment).alias("_t")).distinct()
    payload = [c for c in left.columns if c != key]
    one = left.select(key, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*payload).alias("_row"))
    two = moments.select(key, "_t", F.lit(0).alias("_side"), *(["_k"] if keep else []))
    both = one.unionByName(two, allowMissingColumns=True)
    mark = F.when(F.col("_side") == 0, F.struct("_t", *(["_k"] if keep else [])))
    upto = Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    onwards = Window.partitionBy(key).orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_before", F.last(mark, True).over(upto)).withColumn("_after", F.last(mark, True).over(onwards)).where("_side = 1")
    back, ahead = F.col("_t") - F.col("_before._t"), F.col("_after._t") - F.col("_t")
    chosen = F.when(ahead.isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    both = both.withColumn("_near", chosen).withColumn("distance_ms", F.abs(F.col("_t") - F.col("_near._t")))
    ok = F.col("distance_ms") <= within if within is not None else F.lit(True)
    return both.select(key, "_row.*", F.when(ok, F.col("_near._t")).alias("nearest_ms"), F.when(ok, F.col("distance_ms")).alias("distance_ms"), *(F.when(ok, F.col(f"_near._k.{c}")).alias(f"nearest_{c}") for c in keep))


def buckets(lo: Column, hi: Column) -> Column:
    return F.sequence(F.floor(lo / BUCKET_MS), F.floor(F.greatest(lo, hi) / BUCKET_MS))


def points_in(ranges: DataFrame, points: DataFrame, lo: Column, hi: Column, moment: str, key: str = "title_id") -> DataFrame:
    """Pairs of a range and a point with lo <= moment <= hi: an equi-join on the key and a time bucket. Columns of points get the prefix p_."""
    spread = ranges.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi").withColumn("_b", F.explode(buckets(F.col("_lo"), F.col("_hi"))))
    named = points.select(F.col(key), F.floor(F.col(moment) / BUCKET_MS).alias("_b"), *(F.col(c).alias(f"p_{c}") for c in points.columns if c != key))
    return spread.join(named, [key, "_b"]).where((F.col(f"p_{moment}") >= F.col("_lo")) & (F.col(f"p_{moment}") <= F.col("_hi"))).drop("_b", "_lo", "_hi")


def overlapping(a: DataFrame, b: DataFrame, key: str = "title_id") -> DataFrame:
    """Pairs of intervals (start_ms, end_ms) that overlap; columns of b get the prefix p_. A pair is found in the bucket where its overlap starts, and there only."""
    one = a.withColumn("_b", F.explode(buckets(F.col("start_ms"), F.col("end_ms"))))
    two = b.select(F.col(key), *(F.col(c).alias(f"p_{c}") for c in b.columns if c != key)).withColumn("_b", F.explode(buckets(F.col("p_start_ms"), F.col("p_end_ms"))))
    start = F.greatest("start_ms", "p_start_ms")
    return one.join(two, [key, "_b"]).where((F.least("end_ms", "p_end_ms") > start) & (F.floor(start / BUCKET_MS) == F.col("_b"))).drop("_b")
