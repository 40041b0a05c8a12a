"""Cutting lineage, and connected components over stored tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Only where none is named and all runs on this machine, as in tests, one is made and set; it goes when Python ends."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        folder = named
    elif (found := spark.sparkContext.getCheckpointDir()) is not None:
        return found
    else:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="cuelake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so that a lost executor costs nothing that came before. Spark removes what is no longer used where spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that can be reached.

    Alternates two steps until nothing changes: each node ties its larger
    neighbours to its smallest one, then its smaller neighbours and itself. Both
    keep what is connected and flatten every component into a star, in a number of
    rounds that grows with the logarithm of its size. Groups by a node are minima,
    which are combined before the shuffle.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.union(least.select("a", F.col("m").alias("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        before = mark
    raise RuntimeError("components did not settle")
