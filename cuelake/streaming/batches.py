"""Work in batches that can be stopped at any time and goes on where it was.

Cues come as files; each trigger takes the next ones as a batch until none is left. A
batch sees the last cues of what came before it as context. Results and context of a
batch are written under its number, over what a stopped run left there, and then the
number is entered in a log; only batches in the log count. So a batch that is done
again, after a stop at any point, is counted once and sees the same context.

The context is a few cues of each title that came so far; it is written with each batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A step gets the cues of a batch and those before it, told apart by `is_context`, and returns rows for the batch.
Step = Callable[[DataFrame], DataFrame]


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def run(cues: DataFrame, folder: str, step: Step, keep: int = 3) -> int:
    """Takes all batches of a stream of cues that are there; returns how many of them were done in this run. A failing step stops the run; run again, it goes on with the same batch."""
    done: list[int] = []

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if _exists(spark, f"{folder}/log/batch={number}/_SUCCESS"):
            return
        own = batch.withColumn("is_context", F.lit(False))
        if number and _exists(spark, f"{folder}/context/batch={number - 1}"):
            own = own.unionByName(spark.read.schema(own.schema).parquet(f"{folder}/context/batch={number - 1}"))
        step(own).write.mode("overwrite").parquet(f"{folder}/results/batch={number}")
        last = F.row_number().over(Window.partitionBy("title_id").orderBy(F.desc("pos")))
        context = own.withColumn("_r", last).where(F.col("_r") <= keep).drop("_r").withColumn("is_context", F.lit(True))
        context.write.mode("overwrite").parquet(f"{folder}/context/batch={number}")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/log/batch={number}")
        done.append(number)

    query = cues.writeStream.foreachBatch(one).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def results(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the batches in the log, with the batch's number."""
    entered = spark.read.parquet(f"{folder}/log").select("batch").distinct()
    return spark.read.parquet(f"{folder}/results").join(entered, "batch", "left_semi")


def continuity(cues: DataFrame, keep: int = 3) -> DataFrame:
    """(title_id, pos, gap_ms, repeats) of a batch's cues: the gap to the cue before, and how many of the `keep` cues before say the same."""
    along = Window.partitionBy("title_id").orderBy("pos")
    gap = F.col("start_ms") - F.lag("end_ms").over(along)
    same = [F.coalesce((F.lag("text", k).over(along) == F.col("text")).cast("int"), F.lit(0)) for k in range(1, keep + 1)]
    return cues.select("title_id", "pos", gap.alias("gap_ms"), sum(same[1:], same[0]).alias("repeats"), "is_context").where("not is_context").drop("is_context")
