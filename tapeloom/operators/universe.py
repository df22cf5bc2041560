"""The ticker universe: a table of (source, ticker)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "source string, ticker string"


def _norm(col: Column) -> Column:
    return F.upper(F.trim(col))


def source_tickers(name: str, df: DataFrame, col: str = "ticker") -> DataFrame:
    t = _norm(F.col(col))
    return df.select(F.lit(name).alias("source"), t.alias("ticker")).where(
        F.col("ticker").isNotNull() & (F.col("ticker") != "")).distinct()


def register_source(universe: DataFrame, name: str, df: DataFrame, col: str = "ticker") -> DataFrame:
    """Replace the tickers of one source."""
    return universe.where(F.col("source") != name).unionByName(source_tickers(name, df, col))


def build_universe(sources: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [source_tickers(n, d) for n, d in sources.items()])


def _sources_per_ticker(universe: DataFrame) -> DataFrame:
    """Tickers with their number of sources; (source, ticker) pairs are distinct."""
    return universe.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


def universe_intersection(universe: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Tickers in all (named and existing) sources."""
    if names is not None:
        universe = universe.where(F.col("source").isin(*names))
    sources = universe.agg(F.count_distinct("source").alias("n")).scalar()
    return _sources_per_ticker(universe).where(F.col("n") == sources).select("ticker")


def universe_union(universe: DataFrame) -> DataFrame:
    return universe.select("ticker").distinct()


def universe_coverage(universe: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One row per ticker: a flag per source and their number, by ticker."""
    has = {s: F.bool_or(F.col("source") == s).alias(s) for s in sources}
    return universe.groupBy("ticker").agg(
        *has.values(), F.count(F.lit(1)).alias("source_count")).orderBy("ticker")


def universe_summary(universe: DataFrame) -> DataFrame:
    """(measure, count): each source, the number of sources, union and intersection."""
    per_source = universe.groupBy(F.concat(F.lit("source:"), "source").alias("measure")).agg(
        F.count(F.lit(1)).alias("count"))
    total = universe.agg(F.count_distinct("source").alias("n"))
    per_ticker = _sources_per_ticker(universe)
    both = per_ticker.agg(
        F.count(F.lit(1)).alias("union"),
        F.count_if(F.col("n") == total.scalar()).alias("intersection"))
    rest = total.select(F.lit("total_sources").alias("measure"), F.col("n").alias("count"))
    return per_source.unionByName(rest).unionByName(
        both.unpivot([], ["union", "intersection"], "measure", "count"))


def analyzed_tickers(universe: DataFrame, k: int = 2) -> DataFrame:
    """Tickers in at least ``k`` sources; in all of them if there are fewer than ``k``."""
    sources = universe.agg(F.count_distinct("source").alias("n")).scalar()
    return _sources_per_ticker(universe).where(
        F.col("n") >= F.least(F.lit(k).cast("long"), sources)).select("ticker").orderBy("ticker")


def filter_universe(
    df: DataFrame, universe: DataFrame, col: str = "ticker",
    required: Sequence[str] | None = None, min_sources: int | None = None,
) -> DataFrame:
    """Rows whose ticker, trimmed and upper-cased, is in the required sources, in
    at least ``min_sources``, or by default in all."""
    if required:
        keep = universe_intersection(universe, required)
    elif min_sources:
        keep = _sources_per_ticker(universe).where(F.col("n") >= min_sources).select("ticker")
    else:
        keep = universe_intersection(universe)
    keep = keep.select(F.col("ticker").alias("__t"))
    return df.join(keep, _norm(F.col(col)) == F.col("__t"), "left_semi")


def filter_min_sources(df: DataFrame, universe: DataFrame, k: int = 2) -> DataFrame:
    """Rows of tickers in at least ``k`` sources; all rows if fewer sources exist."""
    sources = universe.agg(F.count_distinct("source").alias("n")).scalar()
    few = _sources_per_ticker(universe).where(F.col("n") < k).select("ticker")
    absent = F.col("__known").isNull()
    known = universe_union(universe).join(few, "ticker", "left_anti").withColumn("__known", F.lit(True))
    return df.join(known, "ticker", "left").where(~absent | (sources < k)).drop("__known")


def portfolio_overlap(portfolios: DataFrame) -> DataFrame:
    """Tickers held by more than one strategy, with the strategies."""
    held = portfolios.select("strategy", "ticker").distinct()
    return held.groupBy("ticker").agg(
        F.array_sort(F.collect_list("strategy")).alias("strategies"),
        F.count(F.lit(1)).alias("held_by")).where("held_by > 1")
