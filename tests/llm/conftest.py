import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.common import prepare

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: names that the operators use for columns of their own
CLASHES = (
    "word words row rows n h node key nid comp score label share x part m head to of d bucket ids found content start "
    "piece place total host html_ page fixed menus token kind known predicted held_out members hub n_tokens item_id cosine "
    "next_id slice own other signature bands _key _score _id _h").split()

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
COPY = "the quick brown fox jumps over the lazy dog near the old stone bridge while seven grey birds sing " * 2
EDGES = [
    (1, None, "en", "a", 0), (2, "", "en", None, None), (3, " \t\n ", None, "a", 3), (4, LONG, "en", "a", len(LONG)),
    (5, COPY, "en", "a", 1), (6, COPY, "de", "b", 1), (7, COPY.upper(), "en", "b", 1), (7, COPY.upper(), "en", "b", 1),
    (8, COPY + "indeed", "en", "b", 1), (9, "one two", "fr", "c", 7), (10, "One  two", "fr", "c", 8), (11, "123 456 !!", "es", "c", 9),
    (None, "a text without a key that says little", "en", "d", 1), (12, "short", None, None, None),
    (13, "naïve façade — “quotes” 日本語 ś", "fr", "e", 2), (14, "x" * 5_000, "en", "e", 5_000), (-5, "negative key", "en", "e", 1),
]


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, and columns whose names clash."""
    df = spark.createDataFrame(EDGES, DOCS)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (4, 1, 0), (5, 1, None), (5, 0, None), (6, 0, 1), (None, 1, 1), (9, None, None), (11, 0, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int")


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def crc(x, parts):
    import zlib

    return zlib.crc32(str(x).encode()) % parts
