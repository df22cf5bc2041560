"""Risk metrics per ticker and sector. Input: bars with ``daily_return`` in percent.

Single metrics are aggregates that combine before the shuffle, except drawdown
and quantiles, which have skew-proof forms of their own; all together come from
one summary a ticker and year. Returns are fractions inside this module.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.labels import RISK_FREE
from tapeloom.operators import timeblocks
from tapeloom.operators.economic import day_table
from tapeloom.operators.quantiles import medians, quantiles
from tapeloom.operators.timeblocks import KEY, SLICE

TRADING_DAYS = 252
YEAR_ROOT = math.sqrt(TRADING_DAYS)
MIN_ROWS = 30
MIN_SHARED = 60
TRAILING = 252
DAILY_RF = RISK_FREE / TRADING_DAYS


def fraction() -> Column:
    return F.col("daily_return") / 100


def risk_base(df: DataFrame) -> DataFrame:
    """First and last day, rows, sector, mean and sample deviation of the return, first and last price."""
    r = fraction()
    stats = df.groupBy("ticker").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("date").alias("num_records"),
        F.avg(r).alias("mean_return"),
        F.stddev_samp(r).alias("std_return"),
        F.min_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("first_price"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("last_price"),
        F.stddev_samp(F.when(r < 0, r)).alias("std_down"),
    )
    return stats.join(first_sector(df), "ticker", "left")


def first_sector(df: DataFrame) -> DataFrame:
    """(ticker, sector): the first one seen. Text in an aggregate buffer would make
    the big aggregate sort its input, so names are grouped on, and only the first
    day of each is compared."""
    spans = df.where(F.col("sector").isNotNull()).groupBy("ticker", "sector").agg(
        F.min("date").alias("since"))
    return spans.groupBy("ticker").agg(F.min_by("sector", "since").alias("sector"))


def sharpe(mean: Column, std: Column, rows: Column, rf: float = DAILY_RF) -> Column:
    return F.when((std > 0) & (rows >= MIN_ROWS), (mean - rf) / std * YEAR_ROOT)


def sortino(mean: Column, std_down: Column, rows: Column, rf: float = DAILY_RF) -> Column:
    return F.when((std_down > 0) & (rows >= MIN_ROWS), (mean - rf) / std_down * YEAR_ROOT)


def add_ratios(base: DataFrame) -> DataFrame:
    """Sharpe, Sortino and yearly volatility from :func:`risk_base`."""
    return base.withColumns({
        "sharpe_ratio": sharpe(F.col("mean_return"), F.col("std_return"), F.col("num_records")),
        "sortino_ratio": sortino(F.col("mean_return"), F.col("std_down"), F.col("num_records")),
        "volatility": F.col("std_return") * YEAR_ROOT,
    })


def var95(df: DataFrame) -> DataFrame:
    """(ticker, var_95): the 5 % quantile of the return."""
    return quantiles(df.select("ticker", fraction().alias("__r")), ["ticker"], {"var_95": ("__r", 0.05)})


def max_drawdown(df: DataFrame, by: str = "ticker", order: str = "date", value: str = "close",
                 min_rows: int = MIN_ROWS) -> DataFrame:
    out = timeblocks.drawdown_by(df, [by], order, value)
    return out.select(
        by, F.when(F.col("drawdown_rows") >= min_rows, F.col("max_drawdown")).alias("max_drawdown"))


def benchmark_from_bars(df: DataFrame, ticker: str = "SPY") -> DataFrame:
    """(date, market_return as a fraction)."""
    return df.where(F.col("ticker") == ticker).select("date", fraction().alias("market_return"))


def _shared(df: DataFrame, bench: DataFrame) -> DataFrame:
    """Rows on dates the benchmark has: (ticker, date, r, m)."""
    return (
        df.select("ticker", "date", fraction().alias("r")).where(F.col("r").isNotNull())
        .join(day_table(bench.where(F.col("market_return").isNotNull())), "date")
        .select("ticker", "date", "r", F.col("market_return").alias("m"))
    )


def _slope() -> Column:
    return F.when(F.var_samp("m") > 0, F.covar_samp("r", "m") / F.var_samp("m"))


def beta_static(df: DataFrame, bench: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(ticker, beta_static, alpha, shared): null below ``min_shared`` shared dates."""
    out = _shared(df, bench).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("shared"), _slope().alias("b"),
        F.avg("r").alias("r"), F.avg("m").alias("m"))
    beta = F.when(F.col("shared") >= min_shared, F.col("b"))
    expected = DAILY_RF + F.col("beta_static") * (F.col("m") - DAILY_RF)
    return out.withColumn("beta_static", beta).select(
        "ticker", "shared", "beta_static",
        ((F.col("r") - expected) * TRADING_DAYS).alias("alpha"))


def beta_trailing(df: DataFrame, bench: DataFrame, rows: int = TRAILING) -> DataFrame:
    """(ticker, recent, beta_recent) over the last ``rows`` shared dates. The rank
    filter is applied before the shuffle too, so each task keeps ``rows`` per ticker."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    last = _shared(df, bench).withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= rows)
    return last.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("recent"), _slope().alias("beta_recent"))


def betas(df: DataFrame, bench: DataFrame, rows: int = TRAILING) -> DataFrame:
    """(ticker, beta_static, beta_rolling_252, alpha). Tickers with fewer than
    ``rows`` shared dates use the static value."""
    out = beta_static(df, bench).join(beta_trailing(df, bench, rows), "ticker", "left")
    rolling = F.when(F.col("beta_static").isNotNull(), F.when(
        F.col("recent") >= rows, F.col("beta_recent")).otherwise(F.col("beta_static")))
    return out.select("ticker", "beta_static", rolling.alias(f"beta_rolling_{rows}"), "alpha")


def quality_filter(
    df: DataFrame, min_rows: int = MIN_ROWS, drawdown: float = -0.7, volatility: float = 0.8,
    sharpe_between: tuple[float, float] = (-10, 20),
) -> DataFrame:
    """Percent columns, then the rows within limits."""
    pct = {f"{c}_pct": F.col(c) * 100 for c in ("var_95", "max_drawdown", "volatility", "alpha")
           if c in df.columns}
    return df.withColumns(pct).where(
        (F.col("num_records") >= min_rows) & (F.col("max_drawdown") > drawdown)
        & (F.col("volatility") < volatility) & F.col("sharpe_ratio").between(*sharpe_between))


#: how often each moment is summarised: all returns, losses, days shared with the benchmark
_MOMENTS = {"r": ("r",), "d": ("loss",), "s": ("sr", "sm")}


def slice_summaries(df: DataFrame, bench: DataFrame) -> DataFrame:
    """One row a ticker and year that merges with the others of its ticker (:func:`merge_summaries`).

    Rows, first and last day and price; number, mean and sum of squares around
    the mean of returns and of losses; the same and the product sum with the
    benchmark on shared days; lowest and highest price and deepest fall; and
    the shared days themselves (a year at most), newest first. One shuffle
    brings the rows of a slice together, for the window and the summary.
    """
    days = day_table(bench.where(F.col("market_return").isNotNull()).select("date", "market_return"))
    r, m = F.col("r"), F.col("market_return")
    rows = df.select("ticker", "date", fraction().alias("r"), "close", "sector").join(days, "date", "left").select(
        "*", F.struct("ticker", F.year("date").alias(SLICE)).alias(KEY),
        F.when(r < 0, r).alias("loss"), F.when(m.isNotNull(), r).alias("sr"), F.when(r.isNotNull(), m).alias("sm"))
    w = Window.partitionBy(KEY).orderBy("date")
    peak = F.max("close").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumns({
        "fall": F.try_divide("close", peak) - 1,
        "sector": F.first("sector", True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "since": F.when(F.col("sector").isNotNull(), F.col("date")),
    })
    priced = F.when(F.col("close").isNotNull(), F.col("date"))
    aggs = {
        "num_records": F.count("date"), "first_date": F.min("date"), "last_date": F.max("date"), "since": F.min("since"),
        "first_priced": F.min(priced), "first_price": F.min_by("close", priced),
        "last_priced": F.max(priced), "last_price": F.max_by("close", priced),
        "fall": F.min("fall"), "low": F.min("close"), "high": F.max("close"), "prices": F.count("close"),
        "shared_days": F.reverse(F.array_sort(F.collect_list(F.when(F.col("sm").isNotNull(), F.struct("date", "sr", "sm"))))),
    }
    for kind, columns in _MOMENTS.items():
        aggs[f"n_{kind}"] = F.count(columns[0])
        for c in columns:
            aggs |= {f"mean_{c}": F.avg(c), f"square_{c}": F.var_pop(c) * F.count(c)}
    aggs["product"] = F.covar_pop("sr", "sm") * F.count("sr")
    # the sector is one per slice: as a grouping column it stays out of the buffers
    return rows.groupBy(KEY, "sector").agg(*[c.alias(n) for n, c in aggs.items()]).select("*", f"{KEY}.*").drop(KEY)


def merge_summaries(slices: DataFrame, trailing: int = TRAILING) -> DataFrame:
    """One row a ticker from its slices: everything but the quantile."""
    whole = Window.partitionBy("ticker")
    by_year = whole.orderBy(SLICE)
    counts = {c: F.col(f"n_{kind}") for kind, columns in _MOMENTS.items() for c in columns}
    out = slices.withColumns({
        "later": F.coalesce(F.sum("n_s").over(by_year.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)),
        "before": F.max("high").over(by_year.rowsBetween(Window.unboundedPreceding, -1)),
        **{f"all_{c}": F.try_divide(F.sum(n * F.col(f"mean_{c}")).over(whole), F.sum(n).over(whole)) for c, n in counts.items()},
    })
    off = {c: F.col(f"mean_{c}") - F.col(f"all_{c}") for c in counts}
    square = {c: F.sum(F.col(f"square_{c}") + n * off[c] * off[c]) for c, n in counts.items()}
    product = F.sum(F.col("product") + F.col("n_s") * off["sr"] * off["sm"])
    days = F.slice("shared_days", F.lit(1), F.greatest(F.lit(0), trailing - F.col("later")).cast("int"))

    def over_days(of):  # around the ticker's means, so that the sums of slices just add up
        return F.sum(F.aggregate(days, F.lit(0.0), lambda t, x: t + of(x["sr"] - F.col("all_sr"), x["sm"] - F.col("all_sm"))))

    n, u, v = F.sum(F.size(days)), over_days(lambda r, m: r), over_days(lambda r, m: m)
    recent_square = over_days(lambda r, m: m * m) - v * v / n
    recent_product = over_days(lambda r, m: r * m) - u * v / n

    def deviation(c, kind):
        n = F.sum(f"n_{kind}")
        return F.when(n > 1, F.sqrt(square[c] / (n - 1)))

    shared = F.sum("n_s")
    least = F.max("all_sm") * F.max("all_sm") * 1e-28  # squares of equal numbers may leave a rounding of their mean
    return out.groupBy("ticker").agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.sum("num_records").alias("num_records"),
        F.max("all_r").alias("mean_return"), deviation("r", "r").alias("std_return"), deviation("loss", "d").alias("std_down"),
        F.min_by("first_price", "first_priced").alias("first_price"), F.max_by("last_price", "last_priced").alias("last_price"),
        F.min(F.least(F.col("fall"), F.try_divide("low", "before") - 1)).alias("max_drawdown"), F.sum("prices").alias("prices"),
        shared.alias("shared"), F.when(square["sm"] > shared * least, product / square["sm"]).alias("slope"),
        F.max("all_sr").alias("mean_shared"), F.max("all_sm").alias("mean_market"),
        n.alias("recent"), F.when(recent_square > n * least, recent_product / recent_square).alias("beta_recent"),
        F.min_by("sector", "since").alias("sector"))


def risk_metrics(df: DataFrame, bench: DataFrame | None = None, trailing: int = TRAILING, **limits) -> DataFrame:
    """All metrics per ticker, filtered to the quality universe: one pass over the
    rows for everything but the quantile, from summaries that merge."""
    bench = benchmark_from_bars(df) if bench is None else bench
    beta = F.when(F.col("shared") >= MIN_SHARED, F.col("slope"))
    rolling = F.when(F.col("beta_static").isNotNull(), F.when(
        F.col("recent") >= trailing, F.col("beta_recent")).otherwise(F.col("beta_static")))
    expected = DAILY_RF + F.col("beta_static") * (F.col("mean_market") - DAILY_RF)
    out = add_ratios(merge_summaries(slice_summaries(df, bench), trailing)).withColumns({
        "max_drawdown": F.when(F.col("prices") >= MIN_ROWS, F.col("max_drawdown")),
        "beta_static": beta,
    }).withColumns({
        f"beta_rolling_{trailing}": rolling,
        "alpha": (F.col("mean_shared") - expected) * TRADING_DAYS,
        "beta": rolling,
    }).drop("std_down", "prices", "shared", "slope", "mean_shared", "mean_market", "recent", "beta_recent")
    return quality_filter(out.join(var95(df), "ticker", "left"), **limits)


def sector_risk(metrics: DataFrame) -> DataFrame:
    """Means per sector, best Sharpe first."""
    means = {"avg_sharpe": "sharpe_ratio", "avg_sortino": "sortino_ratio", "avg_volatility": "volatility",
             "avg_beta": "beta", "avg_alpha": "alpha", "avg_max_drawdown": "max_drawdown",
             "avg_var_95": "var_95"}
    out = metrics.groupBy("sector").agg(
        F.count("ticker").alias("num_tickers"), *[F.avg(c).alias(n) for n, c in means.items()])
    return out.withColumns({
        "avg_volatility_pct": F.col("avg_volatility") * 100,
        "avg_max_drawdown_pct": F.col("avg_max_drawdown") * 100,
    }).orderBy(F.desc_nulls_last("avg_sharpe"), "sector")


def risk_compact(df: DataFrame, min_rows: int = 50) -> DataFrame:
    """Percent-based metrics of tickers with more than ``min_rows`` rows."""
    vol = F.stddev_samp("daily_return") * 15.8745
    ratio = F.avg("daily_return") * 252 / (vol + 0.1)
    return df.groupBy("ticker").agg(
        F.avg("daily_return").alias("avg_ret"), F.stddev_samp("daily_return").alias("std_ret"),
        F.count(F.lit(1)).alias("count"), F.max("date").alias("last_date"),
        vol.alias("volatility"), F.greatest(F.lit(-5.0), F.least(F.lit(5.0), ratio)).alias("sharpe_ratio"),
    ).where(F.col("count") > min_rows)


def risk_compact_drawdown(df: DataFrame, min_rows: int = 50) -> DataFrame:
    """The compact metrics with drawdown in percent, filtered, clipped for display."""
    fall = timeblocks.drawdown_by(df, ["ticker"], "date", "close").select(
        "ticker", (F.col("max_drawdown") * 100).alias("max_drawdown"))
    out = risk_compact(df, min_rows).join(fall, "ticker", "left")
    out = out.where((F.col("volatility") < 100) & (F.col("max_drawdown") > -80))
    clip = lambda c, lo, hi: F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(c)))
    return out.select(
        "ticker", F.lit("Unknown").alias("sector"), "sharpe_ratio",
        clip("volatility", 2, 100).alias("volatility"),
        clip("max_drawdown", -99.9, 0).alias("max_drawdown"),
        "avg_ret", F.col("last_date").alias("date"))


def sector_median(metrics: DataFrame) -> DataFrame:
    """Ticker count and medians per sector."""
    counts = metrics.groupBy("sector").agg(F.count("ticker").alias("num_tickers"))
    return counts.join(
        medians(metrics, ["sector"], ["sharpe_ratio", "volatility", "max_drawdown"]), "sector", "left")


def top_by(df: DataFrame, col: str, n: int, key: str = "ticker", ascending: bool = False) -> DataFrame:
    order = F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)
    return df.orderBy(order, key).limit(n)
