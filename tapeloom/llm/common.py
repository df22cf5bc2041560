"""What the operators of this package share: reading, folds, small Arrow batches, staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.session import tune
from tapeloom.sources.staging import stage

__all__ = ["prepare", "read", "fold", "bytes_of", "labelled_sample", "stage", "UPPER", "LOWER", "WORD", "words"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a word: a run without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

#: Whole texts travel to Python in batches of so many rows and bytes.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key falls into fold -1."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(parts)), F.lit(-1))


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, per_class: int) -> DataFrame:
    """(text, label, share) of at most ``per_class`` labelled training documents of either class.

    The documents come in the order of a hash of their key, so the sample is the
    same at every run. A key with several labels takes their mean, 0.5 counting
    as 1. ``share`` is the number of labelled keys that a sampled row stands for.
    ``training`` is a condition on ``doc_id``.
    """
    keys = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
        .where(training & F.col("label").isin(0.0, 1.0))
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in keys.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for value in (0, 1):
        part = (
            keys.where(F.col("label") == value)
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
            .withColumn("share", F.lit(max(sizes.get(value, 0) / per_class, 1.0)))
        )
        picked = part if picked is None else picked.union(part)
    # at most 2 * per_class rows of three numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of(F.col("text")).alias("text")).join(
        F.broadcast(picked), "doc_id").select("text", "label", "share")


LABELLED = T.StructType([
    T.StructField("label", T.IntegerType()),
    T.StructField("share", T.DoubleType()),
    T.StructField("x", T.ArrayType(T.DoubleType())),
])


def in_order(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of one key in one partition and in order, for a function that reads them as a stream.

    Partitions sort outside memory, so a hot key takes time, not memory.
    """
    return df.repartition(key).sortWithinPartitions(key, *order)
