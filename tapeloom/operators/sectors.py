"""Sector, period and market summaries. Bars are averaged to days before any
ordered step, and a sector's days are ordered in calendar slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.operators import metadata, timeblocks
from tapeloom.operators.risk import YEAR_ROOT, first_sector, fraction

SECTOR_RF = 0.02


def _sharpe(mean: Column, std: Column, rf: float) -> Column:
    """Yearly ratio; no deviation gives 0."""
    return F.coalesce(F.when(std > 0, (mean * 252 - rf) / (std * YEAR_ROOT)), F.lit(0.0))


def sector_daily(df: DataFrame) -> DataFrame:
    """(sector, date, mean return as a fraction, mean close)."""
    return df.groupBy("sector", "date").agg(
        F.avg(fraction()).alias("daily_return"), F.avg("close").alias("close"))


def sector_metrics(df: DataFrame, rf: float = SECTOR_RF) -> DataFrame:
    df = metadata.mock_sector(df)
    daily = sector_daily(df)
    r = F.col("daily_return")
    stats = daily.groupBy("sector").agg(
        F.avg(r).alias("m"), F.stddev_samp(r).alias("s"),
        F.stddev_samp(F.when(r < 0, r)).alias("d"), F.product(1 + r).alias("g"))
    counts = df.groupBy("sector").agg(
        F.count_distinct("ticker").alias("num_tickers"), F.count(F.lit(1)).alias("total_records"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    falls = timeblocks.drawdown_by(daily, ["sector"], "date", "close").select(
        "sector", (F.col("max_drawdown") * 100).alias("max_drawdown"))
    return counts.join(stats, "sector").join(falls, "sector", "left").select(
        "sector", "num_tickers", "total_records",
        (F.col("m") * 100).alias("avg_daily_return"),
        ((F.col("g") - 1) * 100).alias("total_return"),
        (F.col("s") * YEAR_ROOT * 100).alias("volatility"),
        _sharpe(F.col("m"), F.col("s"), rf).alias("sharpe_ratio"),
        _sharpe(F.col("m"), F.col("d"), rf).alias("sortino_ratio"),
        "max_drawdown", "min_date", "max_date")


def densest_tickers(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` tickers with most rows: (ticker, num_records)."""
    return df.groupBy("ticker").agg(F.count(F.lit(1)).alias("num_records")).orderBy(
        F.desc("num_records"), "ticker").limit(n)


def keep_densest(df: DataFrame, n: int) -> DataFrame:
    return df.join(densest_tickers(df, n), "ticker", "left_semi")


def ticker_metrics(df: DataFrame, top_n: int = 100, rf: float = SECTOR_RF) -> DataFrame:
    """Metrics of the densest tickers, best Sharpe first."""
    top = keep_densest(df, top_n)
    r = fraction()
    stats = top.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("num_records"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.min_by("close", "date").alias("first_price"), F.max_by("close", "date").alias("last_price"),
        F.avg(r).alias("m"), F.stddev_samp(r).alias("s"), F.avg("volume").alias("avg_volume"))
    falls = timeblocks.drawdown_by(top, ["ticker"], "date", "close").select("ticker", "max_drawdown")
    change = F.when(F.col("first_price") > 0, (F.col("last_price") / F.col("first_price") - 1) * 100)
    return stats.join(first_sector(top), "ticker", "left").join(falls, "ticker", "left").select(
        "ticker", "sector", "num_records", "first_date", "last_date", "first_price", "last_price",
        F.coalesce(change, F.lit(0.0)).alias("price_change_pct"),
        (F.col("m") * 100).alias("avg_daily_return"),
        (F.col("s") * YEAR_ROOT * 100).alias("volatility"),
        _sharpe(F.col("m"), F.col("s"), rf).alias("sharpe_ratio"),
        (F.col("max_drawdown") * 100).alias("max_drawdown"),
        "avg_volume").orderBy(F.desc("sharpe_ratio"), "ticker")


def monthly_performance(df: DataFrame) -> DataFrame:
    return df.groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(
        F.avg("daily_return").alias("avg_return"), F.stddev_samp("daily_return").alias("return_std"),
        F.count("daily_return").alias("trading_days"), F.avg("close").alias("avg_price"),
        F.sum("volume").alias("total_volume"), F.count_distinct("ticker").alias("active_tickers"))


def market_daily(df: DataFrame, since: str = "1990-01-01") -> DataFrame:
    r = F.col("daily_return")
    return df.where(r.isNotNull() & (F.col("date") >= F.lit(since).cast("date"))).groupBy("date").agg(
        F.count_distinct("ticker").alias("n_tickers"), F.avg(r).alias("avg_return"),
        F.stddev_samp(r).alias("volatility"),
        (F.count_if(r > 0).cast("double") / F.count(F.lit(1))).alias("pct_positive"),
        F.avg("close").alias("avg_close"), F.avg(F.abs(r)).alias("avg_abs_return"))


def sector_performance(df: DataFrame, days: int = 365) -> DataFrame:
    """Sectors over the last ``days`` days of data, best return first."""
    newest = df.agg(F.max("date").alias("d")).scalar()
    r = fraction()
    return df.where(F.col("date") >= F.date_sub(newest, days)).groupBy("sector").agg(
        F.count_distinct("ticker").alias("num_stocks"), (F.avg(r) * 252).alias("avg_return"),
        (F.stddev_samp(r) * YEAR_ROOT).alias("volatility"), F.count(F.lit(1)).alias("total_records"),
    ).orderBy(F.desc("avg_return"), "sector")


def total_return_by_ticker(df: DataFrame) -> DataFrame:
    first, last = F.min_by("close", "date"), F.max_by("close", "date")
    return df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("days"), first.alias("first_close"), last.alias("last_close"),
        ((F.try_divide(last, first) - 1) * 100).alias("total_return_pct"))
