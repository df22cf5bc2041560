"""Calendars and gaps. Every table here has at most one row per calendar day,
so its ordered windows are bounded by the length of the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def existing_dates(bars: DataFrame) -> DataFrame:
    return bars.select("date").distinct()


def days_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` of a one-row table."""
    return bounds.where(F.col(start).isNotNull()).select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias("date"))


def _weekdays(days: DataFrame) -> DataFrame:
    return days.where(F.weekday("date") < 5)


def detect_gaps(dates: DataFrame, freq: str = "B", join_within: int = 3) -> DataFrame:
    """Missing stretches (gap_start, gap_end, missing_days): expected days that
    are absent, joined when at most ``join_within`` days apart."""
    bounds = dates.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    expected = days_between(bounds, "a", "b")
    if freq == "B":
        expected = _weekdays(expected)
    missing = expected.join(dates.select("date").distinct(), "date", "left_anti")
    by_day = Window.orderBy("date")
    gap = F.datediff("date", F.lag("date").over(by_day)) > join_within
    island = F.sum(F.when(gap, 1).otherwise(0)).over(
        by_day.rowsBetween(Window.unboundedPreceding, 0))
    return (
        missing.withColumn("island", island).groupBy("island")
        .agg(F.min("date").alias("gap_start"), F.max("date").alias("gap_end"),
             F.count(F.lit(1)).alias("missing_days"))
        .drop("island")
    )


def gap_summary(gaps: DataFrame) -> DataFrame:
    """One row: gaps, days they span (weekends included), days truly missing."""
    span = F.datediff("gap_end", "gap_start") + 1
    return gaps.agg(
        F.count(F.lit(1)).alias("gaps"),
        F.coalesce(F.sum(span), F.lit(0)).cast("long").alias("span_days"),
        F.coalesce(F.sum("missing_days"), F.lit(0)).alias("missing_days"))


def longest_gaps(gaps: DataFrame, n: int = 5) -> DataFrame:
    days = (F.datediff("gap_end", "gap_start") + 1).cast("long")
    return gaps.select("gap_start", "gap_end", days.alias("span_days")).orderBy(
        F.desc("span_days"), "gap_start").limit(n)


def trading_days(bounds: DataFrame, holidays: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Weekdays of a one-row date span that are not holidays."""
    return _weekdays(days_between(bounds, start, end)).join(
        holidays.select("date"), "date", "left_anti")


def partition_lag(dates: DataFrame, target, prefix: str = "") -> DataFrame:
    """One row: newest day, days behind ``target``, and days whose text starts with ``prefix``."""
    newest = F.max("date")
    return dates.agg(
        newest.alias("newest"),
        F.datediff(F.lit(target).cast("date"), newest).cast("long").alias("days_behind"),
        F.count_if(F.col("date").cast("string").startswith(prefix)).alias("in_prefix"))
