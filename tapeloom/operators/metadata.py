"""Company metadata. Grain: one row per ticker unless said otherwise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.functions import labels
from tapeloom.operators import clean

# Fields taken out of the vendor JSON.
JSON_FIELDS = {
    "forward_pe": "forwardPE",
    "trailing_pe": "trailingPE",
    "price_to_book": "priceToBook",
    "enterprise_value": "enterpriseValue",
    "profit_margin": "profitMargins",
    "revenue_growth": "revenueGrowth",
}
# Benchmark symbols, names and categories.
BENCHMARKS = {
    "SPY": ("S&P 500 ETF", "broad_market"),
    "QQQ": ("NASDAQ 100 ETF", "growth"),
    "IWM": ("Russell 2000 ETF", "small_cap"),
    "DIA": ("Dow Jones Industrial Average ETF", "value"),
    "^VIX": ("CBOE Volatility Index", "volatility"),
    "GLD": ("Gold ETF", "commodity"),
    "TLT": ("20+ Year Treasury Bond ETF", "bonds"),
}


def flatten_metadata_json(df: DataFrame, fields: Mapping[str, str] = JSON_FIELDS) -> DataFrame:
    """Six numbers out of ``raw_json``; unreadable text gives nulls, existing columns stay."""
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in fields.values()])
    parsed = F.from_json("raw_json", schema)
    new = {c: parsed[f] for c, f in fields.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def standardize_sectors(df: DataFrame) -> DataFrame:
    if "sector" not in df.columns:
        return df.withColumn("sector", F.lit("Unknown"))
    return df.withColumn("sector_original", F.col("sector")).withColumn(
        "sector", labels.standardize_sector(F.col("sector")))


def add_cap_category(df: DataFrame) -> DataFrame:
    cap = F.col("market_cap") if "market_cap" in df.columns else F.lit(None).cast("double")
    return df.withColumn("market_cap_category", labels.market_cap_category(cap))


def fill_unknown(df: DataFrame) -> DataFrame:
    """Missing text becomes ``Unknown``; numbers stay null. Raw payloads stay too."""
    text = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in ("raw_json", "sector_original")
    ]
    return df.fillna("Unknown", subset=text)


def top_counts(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), col).limit(n)


def build_metadata(df: DataFrame, version: str = "silver_v1") -> DataFrame:
    out = fill_unknown(add_cap_category(standardize_sectors(flatten_metadata_json(df))))
    return clean.stamp(out, version, at="processed_at")


def add_sector_metadata(df: DataFrame, meta: DataFrame | None, key: str = "ticker") -> DataFrame:
    """Replace sector and industry from metadata; what is still unknown gets a
    sector by hash of the ticker."""
    out = df.drop("sector", "industry")
    if meta is not None:
        dim = clean.deduplicate(
            meta.select(F.col("ticker").alias(key), "sector", "industry"), [key])
        out = out.join(dim, key, "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("sector", "industry")})
    known = F.coalesce(F.col("sector"), F.lit("Unknown"))
    auto = labels.hash_sector(F.col(key))
    return out.withColumns({
        "sector": F.when(known == "Unknown", auto).otherwise(known),
        "industry": F.when(known == "Unknown", F.concat(auto, F.lit(" (Auto-assigned)")))
        .otherwise(F.coalesce(F.col("industry"), F.lit("Unknown"))),
    })


def mock_sector(df: DataFrame) -> DataFrame:
    """``Sector_<first letter>`` for every row if the whole table has no sector."""
    known = df.agg(F.count_if(F.col("sector") != "Unknown").alias("n")).scalar()
    letter = F.upper(F.substring("ticker", 1, 1))
    mock = F.when(letter != "", F.concat(F.lit("Sector_"), letter)).otherwise(F.lit("Unknown"))
    return df.withColumn("sector", F.when(known == 0, mock).otherwise(F.col("sector")))


def tickers(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").where(F.col("ticker").isNotNull()).distinct()


def missing_tickers(wanted: DataFrame, have: DataFrame) -> DataFrame:
    return tickers(wanted).join(have.select("ticker"), "ticker", "left_anti")


def benchmark_dim_join(df: DataFrame) -> DataFrame:
    """Name and category of a benchmark, caret stripped, missing volume 0."""
    raw = F.col("ticker")
    rows = BENCHMARKS.items()
    name = F.coalesce(*[F.when(raw == k, F.lit(v[0])) for k, v in rows], raw)
    category = F.coalesce(*[F.when(raw == k, F.lit(v[1])) for k, v in rows], F.lit("unknown"))
    return df.withColumns({
        "benchmark_name": name,
        "category": category,
        "volume": F.coalesce(F.col("volume").cast("long"), F.lit(0)).cast("long"),
    }).withColumn("ticker", F.regexp_replace(raw, r"\^", ""))
