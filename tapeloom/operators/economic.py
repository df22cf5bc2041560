"""Economic indicators. From the pivot on, tables hold one row per calendar day,
which bounds their ordered windows and makes them safe to broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import labels
from tapeloom.operators import calendars, clean

# Series ids to columns, and days until publication.
INDICATOR_COLUMNS = {
    "GDP": "gdp",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "DFF": "fed_funds_rate",
    "DGS10": "treasury_10y",
    "VIXCLS": "vix",
    "DTWEXBGS": "dollar_index",
}
PUBLICATION_LAGS = {
    "gdp": 30,
    "cpi": 15,
    "unemployment_rate": 7,
    "fed_funds_rate": 1,
    "treasury_10y": 1,
    "vix": 0,
    "dollar_index": 1,
}
# Other names a vendor uses for a series.
INDICATOR_ALIASES = {"DXY": "DTWEXBGS"}



def _by_day():
    return Window.orderBy("date")


def day_table(df: DataFrame) -> DataFrame:
    """One row per date, to be sent to every executor: bounded by the calendar."""
    return F.broadcast(clean.deduplicate(df, ["date"]))


def combine_indicators(*sources: DataFrame) -> DataFrame:
    """Union of long series; a later source replaces (date, indicator_id) of an earlier one."""
    out = None
    for rank, src in enumerate(sources):
        src = src.withColumn("__source", F.lit(rank))
        out = src if out is None else out.unionByName(src, allowMissingColumns=True)
    return clean.deduplicate(
        out, ["date", "indicator_id"], clean.newest_first(out, ["date", "indicator_id"], "__source")
    ).drop("__source")


def pivot_indicators(
    df: DataFrame, mapping: Mapping[str, str] = INDICATOR_COLUMNS, order: str | None = None
) -> DataFrame:
    """Long to wide: (date, one column per mapped id); the last value by ``order`` wins."""
    named = labels.alias_sector(F.col("indicator_id"), INDICATOR_ALIASES)
    name = F.coalesce(*[F.when(named == i, F.lit(c)) for i, c in mapping.items()])
    value = F.max_by("value", F.col(order or "value"))
    return (
        df.withColumn("__name", name).where(F.col("__name").isNotNull())
        .groupBy("date").pivot("__name", list(mapping.values())).agg(value)
    )


def to_daily_calendar(df: DataFrame) -> DataFrame:
    """Every calendar day between the first and last date."""
    bounds = df.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return calendars.days_between(bounds, "a", "b").join(df, "date", "left")


def forward_fill(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = cols or [c for c in df.columns if c != "date"]
    so_far = _by_day().rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, True).over(so_far) for c in cols})


def apply_publication_lags(df: DataFrame, lags: Mapping[str, int] = PUBLICATION_LAGS) -> DataFrame:
    """``<col>_realtime``: the value known on the day, on a dense calendar."""
    return df.withColumns({
        f"{c}_realtime": F.lag(c, n).over(_by_day()) if n else F.col(c)
        for c, n in lags.items() if c in df.columns
    })


def derive_indicators(df: DataFrame, year_rows: int = 252) -> DataFrame:
    """Yield slope, yearly inflation over ``year_rows`` rows, real rate, volatility bucket."""
    have = set(df.columns)
    if {"treasury_10y", "fed_funds_rate"} <= have:
        df = df.withColumn("yield_curve_slope", F.col("treasury_10y") - F.col("fed_funds_rate"))
    if {"treasury_10y", "cpi"} <= have:
        yoy = (F.try_divide(F.col("cpi"), F.lag("cpi", year_rows).over(_by_day())) - 1) * 100
        df = df.withColumn("cpi_yoy", yoy).withColumn(
            "real_rate", F.col("treasury_10y") - F.col("cpi_yoy"))
    if "vix" in have:
        df = df.withColumn("vix_regime", labels.vix_bucket(F.col("vix")))
    return df


def _or_null(df: DataFrame, col: str) -> Column:
    return F.col(col) if col in df.columns else F.lit(None).cast("double")


def classify_market_regime(df: DataFrame) -> DataFrame:
    return df.withColumn("market_regime", labels.market_regime(
        _or_null(df, "vix"), _or_null(df, "unemployment_rate"), _or_null(df, "yield_curve_slope")))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """(value, count, pct) of a column."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "pct", F.col("count") * 100.0 / total)


def build_economic(*sources: DataFrame, version: str = "silver_v1") -> DataFrame:
    """Long series to the daily table: combine, pivot, calendar, fill, lags, derived, regime."""
    wide = forward_fill(to_daily_calendar(pivot_indicators(combine_indicators(*sources))))
    out = classify_market_regime(derive_indicators(apply_publication_lags(wide)))
    return clean.stamp(out, version, at="processed_at")


def asof_days(dates: DataFrame, econ: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For each given date the newest non-null values at or before it."""
    marks = dates.select("date").distinct().withColumn("__asked", F.lit(True))
    both = econ.select("date", *cols).join(marks, "date", "full")
    return forward_fill(both, cols).where("__asked").drop("__asked")


def asof_indicators(fact: DataFrame, econ: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach the newest published values to any rows with a date. The series is
    resolved once per day, so the fact rows are joined on equality."""
    return fact.join(day_table(asof_days(fact, econ, cols)), "date", "left")
