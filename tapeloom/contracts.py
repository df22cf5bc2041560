"""Declared shapes of the tables: columns, nullability, allowed values, keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DATE, TIMESTAMP, STRING = T.DateType(), T.TimestampType(), T.StringType()
DOUBLE, LONG = T.DoubleType(), T.LongType()


@dataclass(frozen=True)
class TableContract:
    """``columns`` has the name, the type and whether nulls are allowed."""

    name: str
    columns: tuple[tuple[str, T.DataType, bool], ...]
    key: tuple[str, ...]
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    version: str = "1.0"

    def __post_init__(self):
        for entry in self.columns:
            if not (isinstance(entry, tuple) and len(entry) == 3 and isinstance(entry[0], str)
                    and isinstance(entry[1], T.DataType) and isinstance(entry[2], bool)):
                raise TypeError(f"a column is (name, type, nullable), not {entry!r}")

    def fields(self) -> list[tuple[str, T.DataType, bool]]:
        return list(self.columns)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in self.fields()])


SENTIMENTS = ("positive", "negative", "neutral")

# The table shapes a user of the pipeline reads and writes.
CONTRACTS = {
    c.name: c
    for c in (
        TableContract(
            "bronze_prices",
            (
                ("Date", TIMESTAMP, False),
                ("Ticker", STRING, False),
                ("Open", DOUBLE, False),
                ("High", DOUBLE, False),
                ("Low", DOUBLE, False),
                ("Close", DOUBLE, False),
                ("Volume", LONG, False),
                ("ingested_at", TIMESTAMP, False),
            ),
            ("Date", "Ticker"),
        ),
        TableContract(
            "bronze_stock_metadata",
            (
                ("ticker", STRING, False),
                ("company_name", STRING, True),
                ("sector", STRING, True),
                ("industry", STRING, True),
                ("market_cap", DOUBLE, True),
                ("exchange", STRING, True),
                ("currency", STRING, True),
                ("country", STRING, True),
                ("website", STRING, True),
                ("description", STRING, True),
                ("raw_json", STRING, True),
                ("fetched_at", TIMESTAMP, False),
            ),
            ("ticker",),
        ),
        TableContract(
            "bronze_market_news",
            (
                ("news_id", STRING, False),
                ("title", STRING, False),
                ("summary", STRING, True),
                ("content", STRING, True),
                ("source", STRING, True),
                ("url", STRING, True),
                ("published_at", TIMESTAMP, True),
                ("tickers", STRING, True),
                ("sentiment_score", DOUBLE, True),
                ("sentiment_label", STRING, True),
                ("raw_json", STRING, True),
                ("fetched_at", TIMESTAMP, False),
            ),
            ("news_id",),
        ),
        TableContract(
            "bronze_economic_indicators",
            (
                ("date", TIMESTAMP, False),
                ("indicator_id", STRING, False),
                ("indicator_name", STRING, True),
                ("value", DOUBLE, True),
                ("unit", STRING, True),
                ("frequency", STRING, True),
                ("source_file", STRING, True),
                ("fetched_at", TIMESTAMP, False),
            ),
            ("date", "indicator_id"),
        ),
        TableContract(
            "bronze_benchmarks",
            (
                ("date", TIMESTAMP, False),
                ("ticker", STRING, False),
                ("open", DOUBLE, False),
                ("high", DOUBLE, False),
                ("low", DOUBLE, False),
                ("close", DOUBLE, False),
                ("volume", LONG, False),
                ("fetched_at", TIMESTAMP, False),
            ),
            ("date", "ticker"),
        ),
        TableContract(
            "silver_enriched_stocks",
            (
                ("date", TIMESTAMP, False),
                ("ticker", STRING, False),
                ("open", DOUBLE, False),
                ("high", DOUBLE, False),
                ("low", DOUBLE, False),
                ("close", DOUBLE, False),
                ("volume", LONG, False),
                ("daily_return", DOUBLE, True),
                ("sector", STRING, False),
                ("industry", STRING, False),
                ("market_cap_category", STRING, True),
                ("spy_return", DOUBLE, True),
                ("enriched_at", TIMESTAMP, False),
                ("data_version", STRING, False),
            ),
            ("date", "ticker"),
        ),
        TableContract(
            "silver_processed_news",
            (
                ("date", TIMESTAMP, False),
                ("ticker", STRING, False),
                ("news_count", LONG, False),
                ("avg_sentiment", DOUBLE, True),
                ("positive_count", LONG, True),
                ("negative_count", LONG, True),
                ("neutral_count", LONG, True),
                ("headlines", STRING, True),
                ("processed_at", TIMESTAMP, False),
            ),
            ("date", "ticker"),
        ),
        TableContract(
            "silver_economic_indicators",
            (
                ("date", TIMESTAMP, False),
                ("gdp", DOUBLE, True),
                ("cpi", DOUBLE, True),
                ("unemployment_rate", DOUBLE, True),
                ("fed_funds_rate", DOUBLE, True),
                ("treasury_10y", DOUBLE, True),
                ("vix", DOUBLE, True),
                ("processed_at", TIMESTAMP, False),
            ),
            ("date",),
        ),
    )
}

BARS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])
