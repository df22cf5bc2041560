"""Reading bars, records and texts. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.contracts import BARS
from tapeloom.operators.clean import no_nan

ESSENTIAL = ("date", "ticker", "open", "high", "low", "close", "volume")
# Column names of a vendor file and ours.
VENDOR_COLUMNS = {
    "Date": "date",
    "Symbol": "ticker",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
}


def between(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Inclusive range, written so that it reaches the file scan as a filter."""
    kind = dict(df.dtypes)[col]
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast(kind))
    return df


def read_bars(spark: SparkSession, path: str, columns: Sequence[str] = (), start=None, end=None,
              merge_schema: bool = False) -> DataFrame:
    """Bars from Parquet, plain or partitioned by ``date``: essential and asked-for
    columns that exist, in any letter case, lower-cased, within the dates."""
    raw = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    wanted = {*ESSENTIAL, *[c.lower() for c in columns]}
    df = raw.select(*[F.col(f"`{c}`").alias(c.lower()) for c in raw.columns if c.lower() in wanted])
    return no_nan(between(df, start, end))


def sample_tickers(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """All rows of ``n`` tickers, the first ones by md5 of ticker and seed."""
    picked = df.select("ticker").distinct().orderBy(
        F.md5(F.concat("ticker", F.lit(str(seed))).cast("binary")), "ticker").limit(n)
    return df.join(picked, "ticker", "left_semi")


def read_bars_csv(spark: SparkSession, path: str, schema: T.StructType = BARS) -> DataFrame:
    """Bars from CSV with a header. A cell that cannot be read becomes null."""
    return spark.read.schema(schema).option("header", True).option(
        "mode", "PERMISSIVE").csv(path)


def import_vendor_csv(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """A vendor CSV under our names, within the dates, stamped."""
    names = {v: k for k, v in VENDOR_COLUMNS.items()}
    raw = spark.read.option("header", True).csv(path)  # text columns, in the order of the file
    cast = {f.name: F.col(names[f.name]).try_cast(f.dataType) for f in BARS.fields}
    out = raw.select(*[c.alias(n) for n, c in cast.items()])
    return between(out, start, end).withColumn("ingested_at", F.current_timestamp())


#: tickers of one wide row; a table of more has several rows a day
WIDE_TICKERS = 100


def widen_bars(bars: DataFrame, fields: Sequence[str] = ("open", "high", "low", "close", "volume"),
               width: int = WIDE_TICKERS) -> tuple[DataFrame, list[str]]:
    """Long to wide, for :func:`unpivot_bars`: the table and its places.

    A table has ``width`` places whatever the number of tickers, with the columns
    ``<place>_ticker`` and ``<place>_<field>``; each block of tickers has its own row a
    day. The first bar of a ticker and day counts.
    """
    from tapeloom.sources.staging import stage

    names = stage(bars.select("ticker").distinct(), "wide-tickers")
    buckets = max(1, -(-names.count() * 4 // (3 * width)))  # three quarters full, so that few run over
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy("ticker")) - 1
    placed = (
        names.withColumn("__bucket", F.pmod(F.xxhash64("ticker"), F.lit(buckets)))
        .withColumn("__at", inside)
        .select(F.col("ticker").alias("__name"), (F.col("__bucket") + buckets * F.floor(F.col("__at") / width)).alias("__block"),
                (F.col("__at") % width).alias("__place")))
    # one shuffle by block and day serves every step, so no wide row is shuffled
    rows = bars.join(placed, F.col("ticker").eqNullSafe(F.col("__name"))).repartition("__block", "date")
    one = rows.groupBy("__block", "date", "__place", "ticker").agg(*[F.first(c).alias(c) for c in fields])
    there = F.map_from_entries(F.collect_list(F.struct("__place", F.struct("ticker", *fields))))
    wide = one.groupBy("__block", "date").agg(there.alias("__there"))
    columns = [F.col("__there")[i][c].alias(f"p{i}_{c}") for i in range(width) for c in ("ticker", *fields)]
    return wide.select("date", *columns), [f"p{i}" for i in range(width)]


def unpivot_bars(df: DataFrame, tickers: Sequence[str],
                 fields: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Wide to long: columns ``<ticker>_<field>`` become a row per ticker; rows
    without any value are dropped. Where a place has a column ``<place>_ticker``
    (:func:`widen_bars`), the ticker is what stands there."""
    groups = F.array(*[
        F.struct((F.col(f"`{t}_ticker`") if f"{t}_ticker" in df.columns else F.lit(t)).alias("ticker"), *[
            (F.col(f"`{t}_{f}`").cast("double") if f"{t}_{f}" in df.columns
             else F.lit(None).cast("double")).alias(f) for f in fields])
        for t in tickers
    ])
    long = df.select("date", F.explode(groups).alias("g")).select("date", "g.*")
    out = long.dropna(how="all", subset=list(fields))
    return out.withColumn("volume", F.col("volume").cast("long")) if "volume" in fields else out


def normalize_bars(df: DataFrame) -> DataFrame:
    """Collected rows to the bar shape: bad numbers null, missing volume 0, by date and ticker."""
    missing = [c for c in ESSENTIAL if c not in df.columns]
    if missing:
        raise ValueError(f"bars lack columns {missing}")
    number = lambda c: F.col(c).try_cast("double")
    volume = F.coalesce(number("volume"), F.lit(0.0)).cast("long")
    return df.select(
        F.to_date("date").alias("date"), "ticker",
        *[number(c).alias(c) for c in ("open", "high", "low", "close")],
        volume.alias("volume")).orderBy("date", "ticker")


def canonicalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, ``symbol`` to ``ticker``."""
    return df.toDF(*[c.lower() for c in df.columns]).withColumnsRenamed({"symbol": "ticker"})


def coalesce_sources(sources: Sequence[tuple[int, DataFrame]], newest_first: Column | None = None) -> DataFrame:
    """One row per ticker and date: from the source of lowest priority number.

    Of several rows in one source the one with the largest ``newest_first``
    stays; without it, or at a tie, the one whose other columns hash lowest.
    """
    out = None
    for prio, df in sources:
        df = df.withColumn("__prio", F.lit(prio))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    last = F.xxhash64(*[c for c in out.columns if c != "__prio"])
    newest = [newest_first.desc_nulls_last()] if newest_first is not None else []
    w = Window.partitionBy("ticker", "date").orderBy("__prio", *newest, last)
    return out.withColumn("__rk", F.row_number().over(w)).where("__rk = 1").drop("__rk", "__prio")


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      multi_line: bool = True) -> DataFrame:
    """Record files: a JSON array or object per file, or one per line."""
    return no_nan(spark.read.schema(schema).json(path, multiLine=multi_line))


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): whole files keyed by file name without extension."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return spark.read.text(path, wholetext=True).select(stem.alias("doc_id"), F.col("value").alias("text"))


def merge_fragments(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Daily fragment files as one table, lower-cased; fragments may lack columns."""
    raw = spark.read.option("mergeSchema", "true").parquet(*paths)
    names: dict[str, list[Column]] = {}
    for c in raw.columns:
        names.setdefault(c.lower(), []).append(F.col(f"`{c}`"))
    return raw.select(*[F.coalesce(*cs).alias(n) for n, cs in names.items()])
