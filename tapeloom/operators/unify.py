"""Joins of bars with metadata, benchmark, indicators and news.

Day tables are broadcast (one row per calendar day). Per-ticker and per-article
tables grow with the data and are left to the size check of the optimizer; a
hot ticker in a shuffled join is split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapeloom.functions import labels
from tapeloom.operators import clean, timeblocks, universe as uni
from tapeloom.operators.economic import asof_days, day_table

METADATA_COLUMNS = (
    "ticker", "company_name", "sector", "industry", "market_cap", "market_cap_category",
    "exchange", "country",
)
ECONOMIC_COLUMNS = (
    "vix", "fed_funds_rate", "treasury_10y", "market_regime", "yield_curve_slope",
    "unemployment_rate",
)


def metadata_dim(meta: DataFrame) -> DataFrame:
    return clean.deduplicate(
        meta.select(*[c for c in METADATA_COLUMNS if c in meta.columns]), ["ticker"])


def benchmark_returns(bars: DataFrame, ticker: str = "SPY", prefix: str = "spy") -> DataFrame:
    """(date, <prefix>_return as a fraction, <prefix>_close) of one series."""
    one = bars.where(F.col("ticker") == ticker).select("ticker", "date", "close")
    out = timeblocks.previous(one, ["ticker"], ["date"], {"__prev": F.col("close")})
    return out.select(
        "date",
        (F.try_divide(F.col("close"), F.col("__prev")) - 1).alias(f"{prefix}_return"),
        F.col("close").alias(f"{prefix}_close"))


def join_metadata(prices: DataFrame, meta: DataFrame | None) -> DataFrame:
    """Metadata sector and industry win where present; other clashing columns get ``_meta``."""
    if meta is None:
        return prices
    clash = {c: f"{c}_meta" for c in meta.columns if c != "ticker" and c in prices.columns}
    out = prices.join(meta.withColumnsRenamed(clash), "ticker", "left")
    for c in ("sector", "industry"):
        if c in clash:
            out = out.withColumn(c, F.coalesce(F.col(f"{c}_meta"), F.col(c))).drop(f"{c}_meta")
    return out


def join_benchmark(prices: DataFrame, bench: DataFrame | None) -> DataFrame:
    if bench is None:
        return prices.withColumn("spy_return", F.lit(None).cast("double"))
    return prices.join(day_table(bench), "date", "left")


def join_economic(prices: DataFrame, econ: DataFrame | None) -> DataFrame:
    """Newest indicators at or before each date; a missing regime is ``unknown``."""
    if econ is None:
        return prices.withColumn("market_regime", F.lit("unknown"))
    cols = [c for c in ECONOMIC_COLUMNS if c in econ.columns]
    out = prices.join(day_table(asof_days(prices, econ, cols)), "date", "left")
    if "market_regime" in cols:
        out = out.fillna("unknown", subset=["market_regime"])
    return out


def join_news(prices: DataFrame, news: DataFrame | None) -> DataFrame:
    """News counts default to 0; a missing sentiment stays null."""
    if news is None:
        return prices.withColumns({
            "daily_sentiment": F.lit(None).cast("double"), "daily_news_count": F.lit(0).cast("long")})
    return prices.join(news, ["date", "ticker"], "left").fillna(0, subset=["daily_news_count"])


def unify(
    prices: DataFrame, meta: DataFrame | None, bench: DataFrame | None, econ: DataFrame | None,
    news: DataFrame | None, universe: DataFrame | None = None, min_sources: int = 2,
    version: str = "unified_v1",
) -> DataFrame:
    if universe is not None:  # fewer rows to join; the result is the same
        prices = uni.filter_min_sources(prices, universe, min_sources)
    out = join_metadata(prices, metadata_dim(meta) if meta is not None else None)
    out = join_news(join_economic(join_benchmark(out, bench), econ), news)
    return clean.stamp(out, version, at="unified_at")


def semi_join_universe(df: DataFrame, quality: DataFrame | None) -> DataFrame:
    """Rows of the quality tickers; all rows if there is no such list."""
    if quality is None:
        return df
    return df.join(quality.select("ticker").distinct(), "ticker", "left_semi")


def _first_of(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def economic_features(df: DataFrame, econ: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """VIX, its bucket (0, 1, 2) and 5-day change, EFFR and its 20-day change.

    Changes count rows of the trading-date series, resolved before the join.
    ``dates`` is a cheaper table with the same dates as ``df``, if there is one.
    """
    picked = {"VIX": _first_of(econ, ("vix", "VIX", "VIXCLS")),
              "EFFR": _first_of(econ, ("fed_funds_rate", "EFFR", "DFF"))}
    cols = {k: v for k, v in picked.items() if v}
    if not cols:
        return df
    one = clean.deduplicate(econ.select("date", *[F.col(v).alias(k) for k, v in cols.items()]), ["date"])
    days = asof_days(df if dates is None else dates, one, list(cols))
    by_day = Window.orderBy("date")
    if "VIX" in cols:
        level = labels.buckets(F.col("VIX"), (0, 15, 25, 100), (0.0, 1.0, 2.0))
        change = F.try_divide(F.col("VIX"), F.lag("VIX", 5).over(by_day)) - 1
        days = days.withColumns({"vix_regime": level, "vix_change_5d": change})
    if "EFFR" in cols:
        days = days.withColumn("rate_change_20d", F.col("EFFR") - F.lag("EFFR", 20).over(by_day))
    return df.join(F.broadcast(days), "date", "left")


def attach_news(df: DataFrame, news: DataFrame) -> DataFrame:
    """Sentiment and count of each row's ticker and day, 0 for no news, and the log count.

    Rows with the key of their yearly slice (``timeblocks.KEY``) lie together by it and stay where they are:
    the news of a slice come to them, and days are compared inside it.
    """
    days = news.select("date", "ticker", F.col("avg_sentiment").alias("news_sentiment"), "news_count")
    if timeblocks.KEY in df.columns:
        days = days.where(F.col("ticker").isNotNull()).select(
            timeblocks.slice_key(["ticker"], ["date"]).alias("__of"), F.col("date").alias("__day"), "news_sentiment", "news_count")
        # two bounds and no equality, which would become a key to shuffle by
        same = (F.col(timeblocks.KEY) == F.col("__of")) & (F.col("date") >= F.col("__day")) & (F.col("date") <= F.col("__day"))
        out = df.join(days, same, "left").select(
            "date", "ticker", *[c for c in df.columns if c not in ("date", "ticker")], "news_sentiment", "news_count")
    else:
        out = df.join(days, ["date", "ticker"], "left")
    return out.fillna(0, subset=["news_sentiment", "news_count"]).withColumn("news_attention", F.log1p("news_count"))


def sentiment_mean(w: WindowSpec) -> dict[str, Column]:
    return {"sentiment_ma5": F.avg("news_sentiment").over(timeblocks.frame(w, 5))}


def news_features(df: DataFrame, news: DataFrame) -> DataFrame:
    """:func:`attach_news` and the 5-row mean of sentiment."""
    add = lambda d, w: d.withColumns(sentiment_mean(w))
    return timeblocks.rolling(attach_news(df, news), ["ticker"], ["date"], add, back=4)


# Indicator columns of the daily market table.
MARKET_INDICATORS = {
    "VIXCLS": "vix", "DFF": "fed_rate", "GDP": "gdp", "CPIAUCSL": "cpi",
    "DTWEXBGS": "dollar_index", "DGS10": "treasury_10y",
}


def market_with_econ(market: DataFrame, econ: DataFrame) -> DataFrame:
    """Daily market table with indicators filled forward, then nulls to 0.
    One row per day in and out."""
    named = econ.withColumnsRenamed(MARKET_INDICATORS)
    cols = [c for c in MARKET_INDICATORS.values() if c in named.columns]
    one = day_table(named.select("date", *cols))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    out = market.join(one, "date", "left").withColumns({c: F.last(c, True).over(w) for c in cols})
    return out.fillna(0)


def ticker_sector(df: DataFrame) -> DataFrame:
    """(ticker, sector): the first sector seen, missing ones ``Unknown``."""
    spans = df.groupBy("ticker", F.coalesce("sector", F.lit("Unknown")).alias("sector")).agg(
        F.min("date").alias("since"), F.count("sector").alias("n"))
    since = F.when(F.col("n") > 0, F.col("since"))
    return spans.groupBy("ticker").agg(
        F.coalesce(F.min_by("sector", since), F.lit("Unknown")).alias("sector"))
