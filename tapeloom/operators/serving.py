"""Queries behind a dashboard, over the published risk table (one row per ticker)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.quantiles import medians


def market_pulse(risk: DataFrame) -> DataFrame:
    """One row: tickers, median Sharpe and drawdown, mood, counts of good Sharpe."""
    s = F.col("sharpe_ratio")
    counts = risk.agg(
        F.count(F.lit(1)).alias("tickers"), F.count_if(s > 2).alias("sharpe_above_2"),
        F.count_if(s > 1).alias("sharpe_above_1"), F.lit(1).alias("one"))
    middle = medians(risk.withColumn("one", F.lit(1)), ["one"], ["sharpe_ratio", "max_drawdown"])
    mood = (
        F.when(F.col("median_sharpe") > 1, "Bull").when(F.col("median_sharpe") < 0.5, "Bear")
        .otherwise("Neutral"))
    return (
        counts.join(middle, "one", "left").drop("one")
        .withColumnsRenamed({"sharpe_ratio": "median_sharpe", "max_drawdown": "median_drawdown"})
        .withColumn("mood", mood))


def leaders(risk: DataFrame, n: int = 20, by: str = "sharpe_ratio", ascending: bool = False) -> DataFrame:
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return risk.select("ticker", "sector", "sharpe_ratio", "volatility", "max_drawdown").orderBy(
        order, "ticker").limit(n)


def lookup(risk: DataFrame, ticker: str) -> DataFrame:
    return risk.where(F.col("ticker") == ticker)


def sector_leaders(risk: DataFrame, n: int = 10) -> DataFrame:
    return medians(risk, ["sector"], ["sharpe_ratio"]).orderBy(
        F.desc("sharpe_ratio"), "sector").limit(n)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, count): equal bins from min to max; the last one is closed."""
    x = F.col(col).cast("double")
    span = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("s")).scalar()
    lo, width = span["lo"], (span["hi"] - span["lo"]) / bins
    at = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(x - lo, width), F.lit(0.0))))
    return df.where(x.isNotNull()).groupBy(at.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("count")).select(
        "bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), "count")


def screen(risk: DataFrame, sector: str | None = None, min_sharpe: float | None = None) -> DataFrame:
    out = risk
    if sector is not None:
        out = out.where(F.col("sector") == sector)
    if min_sharpe is not None:
        out = out.where(F.col("sharpe_ratio") >= min_sharpe)
    return out.orderBy(F.desc_nulls_last("sharpe_ratio"), "ticker")


def sector_drill(risk: DataFrame, sector: str | None = None) -> DataFrame:
    """One row: count, mean Sharpe, mean volatility of a sector (or of all)."""
    out = risk if sector is None else risk.where(F.col("sector") == sector)
    return out.agg(
        F.count(F.lit(1)).alias("tickers"), F.avg("sharpe_ratio").alias("avg_sharpe"),
        F.avg("volatility").alias("avg_volatility"))


def sector_compare(sectors: DataFrame, metric: str) -> DataFrame:
    return sectors.orderBy(F.desc_nulls_last(metric), "sector")


def sector_list(risk: DataFrame) -> DataFrame:
    return risk.select("sector").where(F.trim("sector") != "").distinct().orderBy("sector")


def derive_missing(df: DataFrame, rf: float = 0.04) -> DataFrame:
    """Sharpe, drawdown and average return from what the table has."""
    have = set(df.columns)
    if "sharpe_ratio" not in have and {"avg_return", "volatility"} <= have:
        df = df.withColumn("sharpe_ratio", (F.col("avg_return") * 252 - rf)
                           / (F.col("volatility") * (252 ** 0.5) + 0.001))
    if "max_drawdown" not in have and "volatility" in have:
        df = df.withColumn("max_drawdown", -F.col("volatility") * 100 * 2)
    if "avg_daily_return" not in have and "avg_ret" in have:
        df = df.withColumn("avg_daily_return", F.col("avg_ret"))
    return df


def group_small_segments(df: DataFrame, name: str, value: str, threshold: float = 0.02,
                         label: str = "Others") -> DataFrame:
    """(name, value, is_others): segments under the share fold into one."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    small = ~F.coalesce(F.try_divide(F.col(value), total) >= threshold, F.lit(False))
    out = df.groupBy(
        F.when(small, F.lit(label)).otherwise(F.col(name)).alias(name), small.alias("is_others")
    ).agg(F.sum(value).alias(value))
    return out.where(~F.col("is_others") | (F.col(value) > 0)).orderBy(
        "is_others", F.desc(value), name)


def page(df: DataFrame, order: str, number: int, size: int = 20, key: str = "ticker",
         ascending: bool = True) -> DataFrame:
    """Page ``number`` (from 1) of the rows in a total order."""
    col = F.asc_nulls_last(order) if ascending else F.desc_nulls_last(order)
    return df.orderBy(col, key).offset((number - 1) * size).limit(size)
