"""Sliced and blocked windows against plain windows, with a hot key."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.operators import features, timeblocks as tb


def series(seed=1, hot=900, others=12):
    """One key with most rows, short ones, sparse years, nulls."""
    rnd = random.Random(seed)
    rows = []
    for k in ["HOT", *[f"T{i}" for i in range(others)]]:
        n = hot if k == "HOT" else rnd.choice([1, 2, 5, 40, 130])
        days = sorted(rnd.sample(range(0, 9000 if n < 100 else 4000), n))
        for d in days:
            v = None if rnd.random() < 0.05 else round(rnd.uniform(1, 100), 3)
            rows.append((k, (pd.Timestamp("1990-01-01") + pd.Timedelta(days=d)).date(), v))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(series(), "k string, date date, v double").repartition(5).cache()


def same(a, b, cols):
    left = a.select(cols).toPandas().sort_values(cols[:2]).reset_index(drop=True)
    right = b.select(cols).toPandas().sort_values(cols[:2]).reset_index(drop=True)
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=1e-12)


def plain():
    return Window.partitionBy("k").orderBy("date")


def test_running_sum(data):
    w = plain().rowsBetween(Window.unboundedPreceding, 0)
    same(tb.running_sum(data, ["k"], ["date"], {"s": F.col("v")}),
         data.withColumn("s", F.sum("v").over(w)), ["k", "date", "s"])


def test_row_numbers(data):
    same(tb.row_numbers(data, ["k"], ["date"], "n"),
         data.withColumn("n", F.row_number().over(plain())), ["k", "date", "n"])


def test_series_size(data):
    same(tb.series_size(data, ["k"], ["date"], "n"),
         data.withColumn("n", F.count("*").over(Window.partitionBy("k"))), ["k", "date", "n"])


def test_previous_keeps_nulls(data):
    same(tb.previous(data, ["k"], ["date"], {"p": F.col("v")}),
         data.withColumn("p", F.lag("v").over(plain())), ["k", "date", "p"])


def test_last_known(data):
    w = plain().rowsBetween(Window.unboundedPreceding, 0)
    same(tb.last_known(data, ["k"], ["date"], {"f": F.col("v")}),
         data.withColumn("f", F.last("v", True).over(w)), ["k", "date", "f"])


def test_drawdown(data):
    w = plain().rowsBetween(Window.unboundedPreceding, 0)
    full = data.where("v is not null")
    want = full.withColumn("d", F.col("v") / F.max("v").over(w) - 1).groupBy("k").agg(
        F.min("d").alias("max_drawdown"), F.count("*").alias("drawdown_rows"))
    same(tb.drawdown_by(data, ["k"], "date", "v"), want, ["k", "drawdown_rows", "max_drawdown"])


@pytest.mark.parametrize("block", [7, 10, 64, 5000])
def test_rolling_any_block_size(data, block):
    add = lambda d, w: d.withColumns({
        "m": F.avg("v").over(tb.frame(w, 7)), "l": F.lag("v", 6).over(w), "a": F.lead("v", 3).over(w)})
    got = tb.rolling(data, ["k"], ["date"], add, back=6, ahead=3, block_rows=block)
    same(got, add(data, plain()), ["k", "date", "m", "l", "a"])
    assert got.columns == ["k", "date", "v", "m", "l", "a"]


def test_rolling_refuses_short_blocks(data):
    with pytest.raises(ValueError):
        tb.rolling(data, ["k"], ["date"], lambda d, w: d, back=20, block_rows=10)


def test_hot_key_is_split(data):
    """No group of the blocked frame is larger than a block and its edges."""
    sizes = []

    def spy(frame, w):
        sizes.append(frame.groupBy("k", tb.BLOCK).count().agg(F.max("count")).first()[0])
        return frame

    tb.rolling(data, ["k"], ["date"], spy, back=5, block_rows=50).count()
    assert sizes[0] <= 55


@pytest.mark.parametrize("span", [3, 9, 12, 26])
def test_ema_against_recursion(spark, span):
    rnd = np.random.default_rng(span)
    x = 100 * np.exp(np.cumsum(rnd.normal(0, 0.02, 2500)))
    pdf = pd.DataFrame({"ticker": "A", "date": pd.date_range("1980-01-01", periods=2500).date, "close": x})
    out = features.ema(spark.createDataFrame(pdf), (span,), block_rows=600).toPandas().sort_values("date")
    want = pdf["close"].ewm(span=span, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(out[f"ema_{span}"].to_numpy(), want, rtol=1e-13)


def test_macd_against_recursion(spark):
    rnd = np.random.default_rng(0)
    x = 50 + np.cumsum(rnd.normal(0, 1, 3000)) * 0.1
    pdf = pd.DataFrame({"ticker": "A", "date": pd.date_range("1980-01-01", periods=3000).date, "close": x})
    out = features.macd(spark.createDataFrame(pdf), block_rows=1100).toPandas().sort_values("date")
    ewm = lambda s, n: s.ewm(span=n, adjust=False).mean()
    line = ewm(pdf.close, 12) - ewm(pdf.close, 26)
    np.testing.assert_allclose(out["macd"], line, rtol=0, atol=1e-11)
    np.testing.assert_allclose(out["macd_signal"], ewm(line, 9), rtol=0, atol=1e-11)


def gappy(n, seed, share=0.2, lead=0):
    """A walk with missing values, runs of them longer than a block, and none before ``lead``."""
    rnd = np.random.default_rng(seed)
    x = 100 * np.exp(np.cumsum(rnd.normal(0, 0.02, n)))
    x[rnd.random(n) < share] = np.nan
    x[n // 3:n // 3 + n // 6] = np.nan
    x[:lead] = np.nan
    return x


@pytest.mark.parametrize("block", [5, 37, 400, None])
def test_averages_over_missing_closes(spark, block):
    rows = {"A": gappy(1500, 1), "B": gappy(700, 2, 0.9, lead=90), "C": gappy(40, 3, 0, lead=40), None: gappy(120, 4)}
    table = [(k, (pd.Timestamp("1990-01-01") + pd.Timedelta(days=i)).date(), None if np.isnan(v) else float(v))
             for k, x in rows.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(table, "ticker string, date date, close double").repartition(7)
    spans = (2, 12, 26, 3000)
    got = features.ema(df, spans, block_rows=block).join(features.macd(df, block_rows=block).withColumnsRenamed(
        {"ticker": "t", "date": "d", "close": "c"}), F.col("ticker").eqNullSafe(F.col("t")) & (F.col("date") == F.col("d"))).toPandas()
    assert len(got) == len(table)
    ewm = lambda s, n: s.ewm(span=n, adjust=False).mean()
    for k, x in rows.items():
        mine = got[got.ticker.isna() if k is None else got.ticker == k].sort_values("date")
        s = pd.Series(x)
        for n in spans:
            np.testing.assert_allclose(mine[f"ema_{n}"].astype(float), ewm(s, n), rtol=1e-11)
        line = ewm(s, 12) - ewm(s, 26)
        np.testing.assert_allclose(mine["macd"].astype(float), line, rtol=0, atol=1e-10)
        np.testing.assert_allclose(mine["macd_signal"].astype(float), ewm(line, 9), rtol=0, atol=1e-10)
        np.testing.assert_allclose(mine["macd_hist"].astype(float), line - ewm(line, 9), rtol=0, atol=1e-10)


def test_averages_of_a_long_series(spark):
    x = gappy(10_000, 7, 0.01)
    pdf = pd.DataFrame({"ticker": "A", "date": pd.date_range("1970-01-01", periods=len(x)).date, "close": x})
    df = spark.createDataFrame(pdf).withColumn("close", F.nanvl("close", F.lit(None).cast("double")))
    out = features.ema(df).toPandas().sort_values("date")
    for n in (12, 26):
        want = pd.Series(x).ewm(span=n, adjust=False).mean()
        np.testing.assert_allclose(out[f"ema_{n}"].astype(float), want, rtol=1e-11)


def test_average_after_one_missing_close(spark):
    rows = [("A", (pd.Timestamp("2020-01-01") + pd.Timedelta(days=i)).date(), None if i == 3 else 100.0) for i in range(9)]
    out = features.ema(spark.createDataFrame(rows, "ticker string, date date, close double"), (12,)).collect()
    assert len(out) == 9 and all(abs(r["ema_12"] - 100) < 1e-12 for r in out)
    with pytest.raises(ValueError):
        features.Averages((1,))


def test_decayed_sums_over_several_stretches(spark):
    rnd = np.random.default_rng(3)
    decay, add = rnd.choice([0.0, 0.01, 30.0, 900.0], 300), rnd.normal(0, 1, 300)
    df = spark.createDataFrame([("a", i, float(d), float(v)) for i, (d, v) in enumerate(zip(decay, add))], "k string, i int, d double, v double")
    got = tb.decayed_sums(df, ["k"], "i", {"y": (F.col("d"), F.col("v"))}).orderBy("i").toPandas()["y"]
    y, want = 0.0, []
    for d, v in zip(decay, add):
        y = np.exp(-d) * y + v
        want.append(y)
    np.testing.assert_allclose(got, want, rtol=1e-9)  # rounding of a total decay of 70,000


def test_null_keys_are_series(spark):
    rows = [(k, (pd.Timestamp("1999-12-25") + pd.Timedelta(days=i)).date(), float(i)) for k in (None, "a", "") for i in range(20)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    out = tb.previous(tb.row_numbers(df, ["k"], ["date"], "n"), ["k"], ["date"], {"p": F.col("v")}).collect()
    assert len(out) == 60 and all(r["n"] == r["v"] + 1 and (r["p"] == r["v"] - 1 or r["v"] == 0 and r["p"] is None) for r in out)


def test_carry_shuffles_the_rows_once(spark, data):
    """Numbering: the rows, their summary, its window and the join of the summary."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tb.row_numbers(data, ["k"], ["date"], "n")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_carries_share_one_pass(spark, data):
    by, order = ["k"], ["date"]
    got = tb.with_carries(data, by, order, tb.before(order, {"p": F.col("v")}), tb.sizes(by, "size"), tb.numbers("n"))
    w = plain()
    want = data.withColumns({"p": F.lag("v").over(w), "size": F.count("*").over(Window.partitionBy("k")), "n": F.row_number().over(w)})
    same(got, want, ["k", "date", "p", "size", "n"])
    with pytest.raises(ValueError):
        tb.with_carries(data, by, order, tb.numbers("n"), tb.numbers("m"))
