"""Backtest results as tables: rebalances, drifting weights, costs, summaries.

Tables of dates and of portfolio values have one row per calendar day (and
strategy), which bounds their ordered windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.operators import timeblocks
from tapeloom.operators.risk import YEAR_ROOT
from tapeloom.sources.staging import stage

COMMISSION = 0.001
SLIPPAGE = 0.0005
CAPITAL = 100_000.0


def rebalance_dates(dates: DataFrame, freq: str = "monthly") -> DataFrame:
    """The first date, and the first of each month or week (``weekly``), or every date (``daily``)."""
    units = {"daily": None, "weekly": "week", "monthly": "month"}
    if freq not in units:
        raise ValueError(f"unknown frequency {freq}")
    days = dates.select("date").distinct()
    if freq == "daily":
        return days
    before = F.lag("date").over(Window.orderBy("date"))
    changed = before.isNull() | (F.trunc("date", units[freq]) != F.trunc(before, units[freq]))
    return days.withColumn("__new", changed).where("__new").select("date")


def equal_weight_targets(bars: DataFrame, dates: DataFrame, n: int = 10) -> DataFrame:
    """(date, ticker, weight): the first ``n`` tickers of each rebalance day."""
    w = Window.partitionBy("date").orderBy("ticker")
    top = (
        bars.select("date", "ticker").join(F.broadcast(dates.select("date").distinct()), "date", "left_semi")
        .withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)
    )
    return top.select(
        "date", "ticker",
        (F.lit(1.0) / F.count(F.lit(1)).over(Window.partitionBy("date"))).alias("weight"))


def _period_days(bars: DataFrame, targets: DataFrame) -> DataFrame:
    """(start, until, date): every bar date with the period it lies in; a rebalance date also ends the one before."""
    marked = bars.select("date", F.lit(False).alias("first")).unionByName(
        targets.select("date", F.lit(True).alias("first"))).dropna()
    days = marked.groupBy("date").agg(F.max("first").alias("first"))
    w = Window.orderBy("date")
    own = F.when(F.col("first"), F.col("date"))
    period = lambda start, until: F.struct(start.alias("start"), until.alias("until"))
    days = days.withColumns({
        "start": F.last(own, True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "before": F.last(own, True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "until": F.first(own, True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    })
    ended = F.when(F.col("first") & F.col("before").isNotNull(), period(F.col("before"), F.col("date")))
    own_period = F.when(F.col("start").isNotNull(), period(F.col("start"), F.col("until")))
    return days.select("date", F.explode(F.array_compact(F.array(own_period, ended))).alias("p")).select("p.*", "date")


def segments(bars: DataFrame, targets: DataFrame) -> DataFrame:
    """(start, until, ticker, date, weight, price, entry, value), staged: a row per holding and day of its period.

    A period lasts from a rebalance date to the next one, both included.
    ``price`` is the last close within the period, ``entry`` the close on its
    first day and ``value`` the worth of the holding per unit invested at the
    start. A holding without a positive close on that day is not bought: its
    ``entry`` is null and its weight stays in cash. Weights of one date and
    ticker add up; a null weight is 0.

    Bars are not shuffled where the holdings are small enough to be sent to
    them; a holding has one row per calendar day, which bounds the window.
    """
    weights = targets.dropna(subset=["date", "ticker"]).groupBy(F.col("date").alias("start"), "ticker").agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"))
    held = stage(weights.join(F.broadcast(_period_days(bars, targets)), "start"), "held-days")
    price = F.nanvl(F.col("close").cast("double"), F.lit(None))
    seen = bars.select("ticker", "date", price.alias("close")).join(held, ["ticker", "date"])
    rows = held.withColumn("close", F.lit(None).cast("double")).unionByName(seen).groupBy(held.columns).agg(
        F.max("close").alias("close"))
    so_far = Window.partitionBy("start", "ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    first = F.first("close").over(so_far)
    out = rows.withColumns({"price": F.last("close", True).over(so_far), "entry": F.when(first > 0, first)})
    grown = F.coalesce(F.col("price") / F.col("entry"), F.lit(1.0))
    return stage(out.select(
        "start", "until", "ticker", "date", "weight", "price", "entry", (F.col("weight") * grown).alias("value")), "segments")


def unpriced_holdings(held: DataFrame) -> DataFrame:
    """(start, ticker, weight) of the holdings of ``segments`` that could not be bought."""
    return held.where((F.col("date") == F.col("start")) & F.col("entry").isNull()).select("start", "ticker", "weight")


def period_values(bars: DataFrame, targets: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(start, date, growth): value of 1 invested at the start of each period.
    A ticker without a bar keeps its last close within the period.

    Here and below, ``held`` is ``segments(bars, targets)`` where the caller has it."""
    held = segments(bars, targets) if held is None else held
    return held.groupBy("start", "date").agg(F.sum("value").alias("growth"))


def rebalance_moves(bars: DataFrame, targets: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(date, ticker, old, new): drifted and target weight of every holding on each rebalance day."""
    held = segments(bars, targets) if held is None else held
    ends = held.where(F.col("date") == F.col("until"))
    total = ends.groupBy("date").agg(F.sum("value").alias("total"))
    bought = F.col("entry").isNotNull()
    old = ends.where(bought).join(F.broadcast(total), "date").select(
        "date", "ticker", F.try_divide("value", "total").alias("old"), F.lit(0.0).alias("new"))
    new = held.where((F.col("date") == F.col("start")) & bought).select(
        "date", "ticker", F.lit(0.0).alias("old"), F.col("weight").alias("new"))
    return old.unionByName(new).groupBy("date", "ticker").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))


def rebalance_costs(bars: DataFrame, targets: DataFrame, commission: float = COMMISSION,
                    slippage: float = SLIPPAGE, held: DataFrame | None = None) -> DataFrame:
    """(date, turnover, cost): weight moved from the drifted holdings to the
    targets of each rebalance day, as a share of the portfolio."""
    return rebalance_moves(bars, targets, held).groupBy("date").agg(
        F.sum(F.abs(F.col("new") - F.col("old"))).alias("turnover")).withColumn(
        "cost", F.col("turnover") * (commission + slippage))


def rebalance_trades(bars: DataFrame, targets: DataFrame, values: DataFrame, commission: float = COMMISSION,
                     slippage: float = SLIPPAGE, least: float = 1e-9, held: DataFrame | None = None) -> DataFrame:
    """(date, ticker, side, value, commission, slippage) of every trade.

    ``values`` is the portfolio's (date, total_value) after costs, from
    ``portfolio_value``. Changes of weight up to ``least`` are rounding, no trades.
    """
    moves = rebalance_moves(bars, targets, held).withColumn("change", F.col("new") - F.col("old"))
    share = commission + slippage
    day = moves.groupBy("date").agg(F.sum(F.abs("change")).alias("turnover")).join(values, "date").select(
        "date", (F.col("total_value") / (1 - F.col("turnover") * share)).alias("before"))
    return moves.where(F.abs("change") > least).join(F.broadcast(day), "date").withColumn(
        "value", F.abs("change") * F.col("before")).select(
        "date", "ticker", F.when(F.col("change") > 0, "BUY").otherwise("SELL").alias("side"), "value",
        (F.col("value") * commission).alias("commission"), (F.col("value") * slippage).alias("slippage"))


def portfolio_value(bars: DataFrame, targets: DataFrame, capital: float = CAPITAL,
                    commission: float = COMMISSION, slippage: float = SLIPPAGE,
                    held: DataFrame | None = None) -> DataFrame:
    """(date, total_value): growth chained over periods, costs paid at each rebalance."""
    held = segments(bars, targets) if held is None else held
    values = period_values(bars, targets, held)
    costs = rebalance_costs(bars, targets, commission, slippage, held).select(
        F.col("date").alias("start"), "cost")
    ends = values.groupBy("start").agg(F.max_by("growth", "date").alias("growth"))
    w = Window.orderBy("start")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    paid = w.rowsBetween(Window.unboundedPreceding, 0)
    grown = F.coalesce(F.product("growth").over(earlier), F.lit(1.0))
    left = F.product(1 - F.coalesce("cost", F.lit(0.0))).over(paid)
    chain = ends.join(costs, "start", "left").withColumn("base", grown * left)
    day = values.join(F.broadcast(chain.select("start", "base")), "start")
    # a rebalance day is valued after the rebalance
    return day.groupBy("date").agg(
        F.max_by(F.col("growth") * F.col("base"), "start").alias("v")).select(
        "date", (F.col("v") * capital).alias("total_value"))


def value_returns(values: DataFrame, by: str = "strategy") -> DataFrame:
    """Daily return of each value series, first rows dropped."""
    out = timeblocks.previous(values, [by], ["date"], {"__prev": F.col("total_value")})
    return out.where(F.col("__prev").isNotNull()).select(
        by, "date", (F.try_divide(F.col("total_value"), F.col("__prev")) - 1).alias("daily_return"))


def performance_summary(values: DataFrame, by: str = "strategy", rf: float = 0.05,
                        days_per_year: int = 252) -> DataFrame:
    """One row per strategy: total and yearly return, volatility, Sharpe, drawdown, Calmar.
    Years count trading rows."""
    rets = value_returns(values, by).groupBy(by).agg(
        F.avg("daily_return").alias("m"), F.stddev_samp("daily_return").alias("s"),
        F.count(F.lit(1)).alias("n"))
    ends = values.groupBy(by).agg(
        F.min_by("total_value", "date").alias("first_value"),
        F.max_by("total_value", "date").alias("last_value"),
        F.count(F.lit(1)).alias("days"))
    falls = timeblocks.drawdown_by(values, [by], "date", "total_value").select(by, "max_drawdown")
    total = F.try_divide("last_value", "first_value") - 1
    yearly = F.pow(1 + total, F.lit(float(days_per_year)) / F.col("n")) - 1
    ratio = F.when(F.col("s") > 0, (F.col("m") - rf / 252) / F.col("s") * YEAR_ROOT)
    return (
        ends.join(rets, by, "left").join(falls, by, "left")
        .withColumn("annualized_return", F.coalesce(yearly, F.lit(0.0)))
        .select(
            by, "days", "first_value", "last_value", total.alias("total_return"), "annualized_return",
            (F.col("s") * YEAR_ROOT).alias("volatility"),
            F.coalesce(ratio, F.lit(0.0)).alias("sharpe_ratio"), "max_drawdown",
            F.try_divide(F.col("annualized_return"), F.abs("max_drawdown")).alias("calmar_ratio"))
    )
