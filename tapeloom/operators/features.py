"""Rolling features per ticker, in date order.

Rolling features look a bounded number of rows back, so all are computed in
one pass over row blocks, whatever the length of a series. A rolling value is
null until its window is full. An exponential average has no such bound: each
row is an affine map of the average before it, a block of rows composes to one
such map, and the averages that enter the blocks are joined back from a table
with a row a block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapeloom.operators import unify
from tapeloom.operators.timeblocks import BLOCK, BLOCK_ROWS, KEY, ROW, block_key, decayed_sums, frame, full_frame, rolling, row_numbers

YEAR_ROOT = math.sqrt(252)
SMA_PERIODS = (5, 10, 20, 50)
EMA_PERIODS = (12, 26)
ROC_PERIODS = (5, 10, 20)
VOLATILITY_PERIODS = (10, 20, 60)
RETURN_PERIODS = (1, 5, 10, 20)

# A feature is a list of waves: each wave maps a window to columns that may use
# the columns of earlier waves. The waves of all features run together, so the
# whole frame needs as many window passes as the longest feature has waves.
Wave = Callable[[WindowSpec], dict[str, Column]]
Step = Sequence[Wave]


def _change(w: WindowSpec, n: int) -> Column:
    return F.try_divide(F.col("close"), F.lag("close", n).over(w)) - 1


def sma_step(periods: Sequence[int] = SMA_PERIODS) -> Step:
    c = F.col("close")
    return [lambda w: {f"sma_{n}": full_frame(F.avg(c), c, w, n) for n in periods}]


def rsi_step(period: int = 14) -> Step:
    """Simple means of gains and losses; the first change counts as 0."""
    d = F.col("__delta")
    ratio = F.try_divide(F.col("__gain"), F.col("__loss"))
    return [
        lambda w: {"__delta": F.coalesce(F.col("close") - F.lag("close", 1).over(w), F.lit(0.0))},
        lambda w: {
            "__gain": full_frame(F.avg(F.greatest(d, F.lit(0.0))), d, w, period),
            "__loss": full_frame(F.avg(F.greatest(-d, F.lit(0.0))), d, w, period)},
        lambda w: {"rsi": 100 - 100 / (1 + ratio)},
    ]


def roc_step(periods: Sequence[int] = ROC_PERIODS) -> Step:
    return [lambda w: {f"roc_{n}": _change(w, n) * 100 for n in periods}]


def returns_step(periods: Sequence[int] = RETURN_PERIODS) -> Step:
    return [lambda w: {f"return_{n}d": _change(w, n) for n in periods}]


def bollinger_step(period: int = 20, width: float = 2.0) -> Step:
    c, middle, half = F.col("close"), F.col("bb_middle"), width * F.col("__sd")
    return [
        lambda w: {
            "bb_middle": full_frame(F.avg(c), c, w, period),
            "__sd": full_frame(F.stddev_samp(c), c, w, period)},
        lambda w: {
            "bb_upper": middle + half,
            "bb_lower": middle - half,
            "bb_width": F.try_divide(2 * half, middle),
            "bb_pct": F.try_divide(c - (middle - half), 2 * half)},
    ]


def atr_step(period: int = 14) -> Step:
    """Mean true range; ``greatest`` skips the missing previous close of the first row."""
    high, low, tr = F.col("high"), F.col("low"), F.col("__tr")

    def true_range(w):
        before = F.lag("close", 1).over(w)
        return {"__tr": F.greatest(high - low, F.abs(high - before), F.abs(low - before))}

    return [true_range, lambda w: {"atr": full_frame(F.avg(tr), tr, w, period)}]


def volatility_step(periods: Sequence[int] = VOLATILITY_PERIODS) -> Step:
    r = F.col("__r")
    return [
        lambda w: {"__r": _change(w, 1)},
        lambda w: {f"volatility_{n}": full_frame(F.stddev_samp(r), r, w, n) * YEAR_ROOT for n in periods},
    ]


def volume_step(mean_rows: int = 20, obv_rows: int = 10) -> Step:
    """Volume over its mean, and whether on-balance volume is above its mean.

    The balance minus its mean does not depend on where the sum starts, so the
    sum may start at the edge of a block; its mean is defined from the tenth row
    of the series on, not of the block.
    """
    v, obv = F.col("volume"), F.col("__obv")

    def first(w):
        sign = F.coalesce(F.signum(F.col("close") - F.lag("close", 1).over(w)), F.lit(0.0))
        return {
            "volume_ratio": F.try_divide(v.cast("double"), full_frame(F.avg(v), v, w, mean_rows)),
            "__flow": sign * v}

    return [
        first,
        lambda w: {"__obv": F.sum("__flow").over(w.rowsBetween(Window.unboundedPreceding, 0))},
        lambda w: {"__level": F.when(F.col(ROW) >= obv_rows, F.avg(obv).over(frame(w, obv_rows)))},
        lambda w: {"obv_trend": F.when(obv > F.col("__level"), 1).otherwise(-1)},
    ]


def target_step(horizon: int = 1, keep_last: bool = True) -> Step:
    """Forward return and its direction; without a forward return the direction is 0."""
    up = F.col("target_return") > 0
    return [
        lambda w: {"target_return": F.try_divide(F.lead("close", horizon).over(w), F.col("close")) - 1},
        lambda w: {"target_direction": F.when(up, 1).otherwise(0) if keep_last else up.cast("int")},
    ]


@dataclass(frozen=True)
class Averages:
    """Exponential averages of the close, and the MACD line, signal and histogram.

    The average starts at the first close. A missing close leaves it as it is
    and lengthens the gap to the next one: after ``g`` rows the old average
    weighs (1 - alpha)^g, the new close alpha, and both are divided by their sum.
    """

    periods: tuple[int, ...] = EMA_PERIODS
    macd: tuple[int, int, int] | None = (12, 26, 9)

    def __post_init__(self):
        if any(n < 2 for n in self.all):
            raise ValueError("the span of an average is 2 at least")

    @property
    def spans(self) -> tuple[int, ...]:
        """Spans of the averages of closes."""
        return tuple(dict.fromkeys([*self.periods, *(self.macd or ())[:2]]))

    @property
    def all(self) -> tuple[int, ...]:
        return (*self.spans, *(self.macd or ())[2:])

    @property
    def block_rows(self) -> int:
        """Rows over which the weight of the shortest span stays within the range of a double."""
        return min([BLOCK_ROWS, *[int(460 / -math.log(_fade(n))) for n in self.all]])

    def local(self, home: Column) -> Step:
        """Inside a block, from the average at its first close on: average = __p * (that average + __s)."""
        x, before = F.col("__x"), F.col("__o")
        known = x.isNotNull() & before.isNotNull()

        def weight(n):
            return F.pow(F.lit(_fade(n)), F.col(ROW) - before)

        def so_far(w):
            return w.rowsBetween(Window.unboundedPreceding, 0)

        waves = [
            lambda w: {"__x": F.when(home, F.col("close").cast("double"))},
            lambda w: {"__o": F.last(F.when(x.isNotNull(), F.col(ROW)), True).over(w.rowsBetween(Window.unboundedPreceding, -1))},
            lambda w: {f"__p_{n}": F.product(F.when(known, weight(n) / (weight(n) + _alpha(n))).otherwise(1.0)).over(so_far(w))
                       for n in self.spans},
            lambda w: {f"__s_{n}": F.sum(F.when(known, _alpha(n) * x / (weight(n) + _alpha(n)) / F.col(f"__p_{n}")).otherwise(0.0))
                       .over(so_far(w)) for n in self.spans},
        ]
        if self.macd:
            fast, slow, signal = self.macd
            begun = before.isNotNull() | x.isNotNull()
            after = lambda v: F.when(home & begun, v / F.col("__f")).otherwise(0.0)
            p, q = F.col(f"__p_{fast}"), F.col(f"__p_{slow}")
            sums = {
                "__z": F.when(home & ~begun, 1 / F.col("__f")).otherwise(0.0), "__zf": after(p), "__zs": after(q),
                "__zc": after(p * F.col(f"__s_{fast}") - q * F.col(f"__s_{slow}"))}
            waves += [
                lambda w: {"__f": F.when(home, F.pow(F.lit(_fade(signal)), F.sum(home.cast("int")).over(so_far(w))))},
                lambda w: {n: F.sum(c).over(so_far(w)) for n, c in sums.items()},
            ]
        return waves

    def entering(self, block: DataFrame, home: Column, by: Sequence[str]) -> DataFrame:
        """One row a block: the averages before it and at its first close, and the signal before it."""
        own, row = F.col("__x"), F.col(ROW)
        at_end = lambda c: F.max_by(c, row)
        aggs = {"first": F.min(F.when(own.isNotNull(), row)), "last": F.max(F.when(own.isNotNull(), row)),
                "x": F.min_by(own, F.when(own.isNotNull(), row)), "rows": F.count(F.lit(1))}
        for n in self.spans:
            aggs |= {f"p_{n}": at_end(F.col(f"__p_{n}")), f"c_{n}": at_end(F.col(f"__p_{n}") * F.col(f"__s_{n}"))}
        if self.macd:
            aggs |= {n: at_end(F.col(f"__{n}")) for n in ("f", "z", "zf", "zs", "zc")}
        out = block.where(home).groupBy(KEY).agg(*[c.alias(n) for n, c in aggs.items()]).select("*", f"{KEY}.*")
        w = Window.partitionBy(*by).orderBy(BLOCK)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("gap", F.col("first") - F.last("last", True).over(before))

        # the first close: old weight times the average before, plus the rest
        def old(n):
            return F.pow(F.lit(_fade(n)), F.col("gap"))

        terms = {}
        for n in self.spans:
            rest = _alpha(n) * F.col("x") / (old(n) + _alpha(n))
            begins = F.coalesce(rest, F.col("x"))  # the series' first close has no gap
            decay = F.coalesce(-F.col("gap") * math.log(_fade(n)) + F.log(old(n) + _alpha(n)) - F.log(F.col(f"p_{n}")), F.lit(0.0))
            terms[f"y_{n}"] = (decay, F.coalesce(F.col(f"p_{n}") * begins + F.col(f"c_{n}"), F.lit(0.0)))
        out = decayed_sums(out, by, BLOCK, terms)
        out = out.withColumns({f"in_{n}": F.lag(f"y_{n}", 1).over(w) for n in self.spans})
        # nothing before the first close, although the sums are 0 there
        out = out.withColumns({f"in_{n}": F.when(F.count("first").over(before) > 0, F.col(f"in_{n}")) for n in self.spans})
        out = out.withColumns({
            f"at_{n}": F.coalesce((old(n) * F.col(f"in_{n}") + _alpha(n) * F.col("x")) / (old(n) + _alpha(n)), F.col("x"))
            for n in self.spans})
        cols = [*[f"in_{n}" for n in self.spans], *[f"at_{n}" for n in self.spans]]
        if self.macd:
            fast, slow, signal = self.macd
            out = decayed_sums(out, by, BLOCK, {"signal": (
                -F.col("rows") * math.log(_fade(signal)), F.col("f") * _alpha(signal) * self._lines("", "in_", "at_"))})
            out = out.withColumn("before", F.coalesce(F.lag("signal", 1).over(w), F.lit(0.0)))
            cols.append("before")
        return out.select(KEY, *[F.col(c).alias(f"__{c}") for c in cols])

    def _lines(self, own: str, entered: str, first: str) -> Column:
        """Sum so far of the MACD lines of a block, each over the signal's weight at its row."""
        fast, slow, _ = self.macd
        difference = F.coalesce(F.col(f"{entered}{fast}") - F.col(f"{entered}{slow}"), F.lit(0.0))
        at = [F.coalesce(F.col(f"{first}{n}"), F.lit(0.0)) for n in (fast, slow)]
        return F.col(f"{own}z") * difference + F.col(f"{own}zf") * at[0] - F.col(f"{own}zs") * at[1] + F.col(f"{own}zc")

    def columns(self) -> list[dict[str, Column]]:
        """The averages of each row, from the local columns and those of :meth:`entering`."""
        begun = F.col("__o").isNotNull() | F.col("__x").isNotNull()
        average = {n: F.when(begun, F.col(f"__p_{n}") * (F.col(f"__at_{n}") + F.col(f"__s_{n}"))).otherwise(F.col(f"__in_{n}"))
                   for n in self.spans}
        out = {f"ema_{n}": average[n] for n in self.periods}
        if not self.macd:
            return [out]
        fast, slow, signal = self.macd
        line = average[fast] - average[slow]
        # the first line of a series is 0, so its weight in the signal does not matter
        faded = F.col("__f") * (F.col("__before") + _alpha(signal) * self._lines("__", "__in_", "__at_"))
        return [out | {"macd": line, "macd_signal": F.when(line.isNotNull(), faded)},
                {"macd_hist": F.col("macd") - F.col("macd_signal")}]


def _alpha(span: int) -> float:
    return 2 / (span + 1)


def _fade(span: int) -> float:
    return 1 - 2 / (span + 1)


def together(*steps: Step) -> list[Wave]:
    """Several features side by side."""
    def at(i: int) -> Wave:
        return lambda w: {n: c for s in steps if i < len(s) for n, c in s[i](w).items()}

    return [at(i) for i in range(max((len(s) for s in steps), default=0))]


def _run(df: DataFrame, steps: Sequence[Step], back: int, ahead: int = 0, averages: Averages | None = None,
         block_rows: int | None = None, prices: DataFrame | None = None, **kw) -> DataFrame:
    """``prices`` are the rows of ``df`` before anything was joined to them: the
    averages that enter the blocks need no more."""
    by, order = ["ticker"], ["date"]
    most = averages.block_rows if averages else BLOCK_ROWS
    block_rows = min(block_rows or most, most)
    home = F.col(BLOCK) == F.floor((F.col(ROW) - 1) / block_rows)

    def build(block, w):
        entering = None
        if averages:
            local = averages.local(home)
            narrow = row_numbers((df if prices is None else prices).select(*by, *order, "close"), by, order, slice_by=kw.get("slice_by"))
            narrow = narrow.withColumn(BLOCK, F.floor((F.col(ROW) - 1) / block_rows)).select(
                block_key(by, F.col(BLOCK)).alias(KEY), ROW, BLOCK, "close")
            for wave in local:
                narrow = narrow.withColumns(wave(w))
            entering = averages.entering(narrow, home, by)
            steps_ = [*steps, local]
        else:
            steps_ = steps
        for wave in together(*steps_):
            block = block.withColumns(wave(w))
        if entering is not None:
            block = block.join(entering, KEY, "left")
            for columns in averages.columns():
                block = block.withColumns(columns)
        return block.drop(*[c for c in block.columns if c.startswith("__") and c not in (ROW, BLOCK, KEY)])

    return rolling(df, by, order, build, back=back, ahead=ahead, block_rows=block_rows, **kw)


def sma(df, periods=SMA_PERIODS, **kw):
    return _run(df, [sma_step(periods)], max(periods), **kw)


def ema(df, periods=EMA_PERIODS, **kw):
    return _run(df, [], 0, averages=Averages(tuple(periods), None), **kw)


def macd(df, fast=12, slow=26, signal=9, **kw):
    return _run(df, [], 0, averages=Averages((), (fast, slow, signal)), **kw)


def rsi(df, period=14, **kw):
    return _run(df, [rsi_step(period)], period + 1, **kw)


def roc(df, periods=ROC_PERIODS, **kw):
    return _run(df, [roc_step(periods)], max(periods), **kw)


def bollinger(df, period=20, width=2.0, **kw):
    return _run(df, [bollinger_step(period, width)], period, **kw)


def atr(df, period=14, **kw):
    return _run(df, [atr_step(period)], period + 1, **kw)


def rolling_volatility(df, periods=VOLATILITY_PERIODS, **kw):
    return _run(df, [volatility_step(periods)], max(periods) + 1, **kw)


def volume_features(df, **kw):
    return _run(df, [volume_step()], 21, **kw)


def returns(df, periods=RETURN_PERIODS, **kw):
    return _run(df, [returns_step(periods)], max(periods), **kw)


def target(df, horizon=1, keep_last=True, **kw):
    return _run(df, [target_step(horizon, keep_last)], 0, horizon, **kw)


def technical_features(df: DataFrame, horizon: int | None = 1, more: Sequence[Step] = (), **kw) -> DataFrame:
    """All price and volume features (and ``more`` steps), in one pass over the blocks."""
    steps = [sma_step(), rsi_step(), roc_step(), bollinger_step()]
    if {"high", "low"} <= set(df.columns):
        steps.append(atr_step())
    steps.append(volatility_step())
    if "volume" in df.columns:
        steps.append(volume_step())
    steps += [returns_step(), *more]
    if horizon:
        steps.append(target_step(horizon))
    return _run(df, steps, 64, horizon or 0, averages=Averages(), **kw)


def engineer_features(df: DataFrame, econ: DataFrame | None = None, news: DataFrame | None = None,
                      horizon: int | None = 1, **kw) -> DataFrame:
    """Price, indicator and news features. News, a row a ticker and day at most, is
    joined to the numbered rows where they lie, before they are cut into blocks, so
    that its rolling mean shares the one pass; indicators are a day table."""
    more, wide = [], df
    if news is not None:
        more.append([unify.sentiment_mean])
        if kw.get("slice_by") is None:
            kw["attach"] = lambda rows: unify.attach_news(rows, news)
        else:
            wide = unify.attach_news(df, news)
    out = technical_features(wide, horizon, more, prices=df, **kw)
    return unify.economic_features(out, econ, dates=df) if econ is not None else out


# The names of the model inputs.
FEATURE_COLUMNS = (
    "sma_5", "sma_10", "sma_20", "sma_50",
    "ema_12", "ema_26",
    "rsi", "macd", "macd_signal", "macd_hist",
    "roc_5", "roc_10", "roc_20",
    "bb_width", "bb_pct",
    "volatility_10", "volatility_20", "volatility_60",
    "volume_ratio", "obv_trend",
    "return_1d", "return_5d", "return_10d", "return_20d",
    "VIX", "vix_regime", "vix_change_5d",
    "EFFR", "rate_change_20d",
    "news_sentiment", "news_count", "news_attention", "sentiment_ma5",
)


def feature_columns(df: DataFrame | None = None) -> list[str]:
    return [c for c in FEATURE_COLUMNS if df is None or c in df.columns]


def describe_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per feature: count, mean, deviation, min, exact quartiles, max.

    ``df`` is computed twice and never written: for the moments and the counts of the
    bins, and for the values of those bins that hold a quartile.
    """
    from tapeloom.operators.quantiles import binned, quantiles
    from tapeloom.sources.staging import stage

    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("p")).select("p.*")
    v, group = F.col("__val"), ["feature", "__col", "__bin"]
    pieces = stage(binned(long, ["feature"], ["v"]).groupBy(*group).agg(
        F.count(v).alias("__n"), F.avg(v).alias("__mean"), F.var_pop(v).alias("__var"),
        F.min(v).alias("__min"), F.max(v).alias("__max")), "feature-bins")
    n, apart = F.col("count"), F.col("__mean") - F.col("mean")
    of = pieces.groupBy("feature").agg(
        F.sum("__n").alias("count"), F.try_divide(F.sum(F.col("__mean") * F.col("__n")), F.sum("__n")).alias("mean"),
        F.min("__min").alias("min"), F.max("__max").alias("max"))
    around = pieces.join(of.select("feature", "mean"), "feature").groupBy("feature").agg(
        F.sum(F.col("__n") * (F.col("__var") + apart * apart)).alias("__m2"))
    stats = of.join(around, "feature").select(
        "feature", "count", "mean", F.when(n > 1, F.sqrt(F.col("__m2") / (n - 1))).alias("std"), "min", "max")
    q = quantiles(long, ["feature"], {"q25": ("v", 0.25), "q50": ("v", 0.5), "q75": ("v", 0.75)}, bins=pieces)
    return stats.join(q, "feature", "left")
