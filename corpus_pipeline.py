"""A corpus pipeline in five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each
result as Parquet to the session's shared folder and hands the next stage what it
reads back. All stages but the last keep the columns of `documents`; columns beyond
those go. An empty table stays empty. When a stage is written the one before it is removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm import bpe, forest, mixing, quality, suffixes
from cuelake.llm.queries import vocabulary
from cuelake.llm.store import remove, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Jaccard similarity of five-word shingles, in %, from which documents are near copies.
NEAR_PERCENT = 80


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: rows that score under 0.5 go. Null and empty texts are scored like others; ids don't matter, repeated rows fare alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels), COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of rows linked at a similarity of NEAR_PERCENT % or more one stays, with the smallest doc_id; null comes after all. Repeated rows are one; null texts and texts without words stay."""
    kept = forest.survivors(docs, NEAR_PERCENT).select(F.col("doc_id").alias("_id"), F.col("h").alias("_kept"))
    own = docs.select(*COLUMNS).withColumn("_h", F.xxhash64("text"))
    met = own.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_kept")), "left_semi")
    return met.dropDuplicates(["doc_id", "_h"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: passages of 50 bytes and more that a smaller doc_id has are cut out of texts. Rows stay, a null text as an empty one; rows without an id are left as they are."""
    return suffixes.cut_texts(docs, COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it; those without words are not taken. A null source is a source."""
    return mixing.copies(docs, COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: token counts and digests, a row for each row."""
    return bpe.encode_digests(docs, vocabulary())


STAGES = [("quality classifier", drop_poor), ("MinHash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats), ("source mixing", mix_sources), ("BPE", encode)]

#: Trees, forests and BPE are beyond SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns, read from the session's shared folder, where it stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        made = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(made)
        docs = spark.read.parquet(made)
        if before is not None:
            remove(spark, before)
        before = made
    return docs
