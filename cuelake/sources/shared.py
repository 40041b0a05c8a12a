"""A folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names in spark.checkpoint.dir. Only where none is named and all runs on this machine, as in tests, it is a temporary one, which goes when Python ends."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="cuelake-")
        atexit.register(shutil.rmtree, top, ignore_errors=True)
    return f"{top}/{name}-{uuid.uuid4().hex}"
