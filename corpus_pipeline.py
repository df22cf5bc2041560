"""From raw documents to packed training sequences, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import decontam, near_dups, packing
from tapeloom.llm import quality as quality_op
from tapeloom.llm import toxicity as toxicity_op
from tapeloom.llm.common import fold, prepare, read, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more; the model is learned outside fold 0 of 5."""
    prepare(spark)
    model = quality_op.learn(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) > 0)
    return docs.select(*COLUMNS, quality_op.score(F.col("text"), model).alias("_score")).where(
        F.col("_score") >= 0.3).select(COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7; the lexicon is learned outside fold 1 of 3."""
    prepare(spark)
    lexicon = toxicity_op.learn(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3).isin(0, 2))
    return docs.select(*COLUMNS, toxicity_op.score(F.col("text"), lexicon).alias("_score")).where(
        F.col("_score") < 0.7).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more)."""
    prepare(spark)
    return near_dups.deduplicated(docs.select(COLUMNS), shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    prepare(spark)
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))  # rows without an id too
    found = decontam.contaminated(docs.select(key.alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    return docs.select(*COLUMNS, key.alias("_key")).join(
        found.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti").select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the remaining documents in batches of equally long sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: the classifiers have no SQL form; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before it kept."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
