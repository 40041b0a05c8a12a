"""Exact order statistics of a whole column, without sorting it in one place.

A rank is found by counting: values are counted in RANGES equal parts of the range in
which the rank lies, the part that holds it is the next range, until a range is one
value. Each pass is one scan with partial counts and hands the driver RANGES counts for
each rank asked for; a column of 64-bit numbers takes seven passes at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.sources.shared import new_folder

RANGES = 1024


def upper_median(n: int) -> int:
    """The rank, from 1, of the upper of the middle values."""
    return n // 2 + 1


def share(percent: int) -> Callable[[int], int]:
    """The smallest rank with `percent` % of the values at or below it."""
    return lambda n: max(1, -(-percent * n // 100))


def select(values: DataFrame, column: str, ranks: dict[str, Callable[[int], int]]) -> dict[str, int | None]:
    """The value of each rank, and n, least, greatest and total, of a column of whole numbers (their range under 2**63); nulls don't count. ranks has functions of n. All but n are None where nothing is left."""
    spark = values.sparkSession
    folder = new_folder(spark, "column")
    values.select(F.col(column).cast("bigint").alias("v")).where("v is not null").write.parquet(folder)
    own = spark.read.schema("v bigint").parquet(folder)
    whole = own.agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total")).first()
    out = {"n": whole["n"], "least": whole["least"], "greatest": whole["greatest"], "total": None if whole["total"] is None else int(whole["total"])} | dict.fromkeys(ranks)
    if not whole["n"]:
        return out
    looking = {name: (whole["least"], whole["greatest"], of(whole["n"])) for name, of in ranks.items()}
    while looking := {name: now for name, now in looking.items() if not _settled(out, name, now)}:
        parts = []
        for name, (lo, hi, _) in looking.items():
            width = -(-(hi - lo + 1) // RANGES)
            part = F.expr(f"(v - ({lo}L)) div {width}L")
            parts.append(F.struct(F.lit(name).alias("name"), F.when(F.col("v").between(lo, hi), part).cast("bigint").alias("part")))
        counts = own.select(F.explode(F.array(*parts)).alias("p")).where("p.part is not null").groupBy("p.name", "p.part").count().collect()  # RANGES rows for each rank at most
        for name, (lo, hi, rank) in looking.items():
            width = -(-(hi - lo + 1) // RANGES)
            for part, n in sorted((r["part"], r["count"]) for r in counts if r["name"] == name):
                if rank <= n:
                    looking[name] = (lo + part * width, min(hi, lo + (part + 1) * width - 1), rank)
                    break
                rank -= n
    return out


def _settled(out: dict, name: str, now: tuple[int, int, int]) -> bool:
    if now[0] == now[1]:
        out[name] = now[0]
    return now[0] == now[1]
