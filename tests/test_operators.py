"""Hand-computed cases."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tapeloom.contracts import CONTRACTS
from tapeloom.functions import labels, text
from tapeloom.operators import calendars, clean, features, models, performance, portfolios, quality, risk, sectors

D = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
BAR = "ticker string, date date, open double, high double, low double, close double, volume bigint"


def priced(spark, closes, ticker="AAPL"):
    df = spark.createDataFrame([(ticker, D(i), float(c)) for i, c in enumerate(closes)],
                               "ticker string, date date, close double")
    return clean.daily_return(df)


def value(df):
    return df.first()[0]


def test_returns_ten_percent(spark):
    got = {r.date: r.daily_return for r in priced(spark, [100, 110, 99]).collect()}
    assert got[D(0)] == 0
    assert got[D(1)] == pytest.approx(10)
    assert got[D(2)] == pytest.approx(-10)


def test_returns_stay_within_ticker(spark):
    both = priced(spark, [100, 110], "AAPL").unionByName(priced(spark, [200, 220], "MSFT"))
    again = clean.daily_return(both.drop("daily_return"))
    assert sorted(round(r.daily_return, 6) for r in again.collect()) == [0, 0, 10, 10]


def test_gates_keep_seven_of_ten(spark):
    rows = [("A", D(i), 10.0, 11.0, 9.0, 10.0, 100) for i in range(10)]
    rows[0] = ("A", D(0), 10.0, 11.0, 9.0, -5.0, 100)
    rows[3] = ("A", D(3), 10.0, 11.0, 9.0, 0.0, 100)
    rows[2] = ("A", D(2), 10.0, 8.0, 9.0, 10.0, 100)
    df = spark.createDataFrame(rows, BAR)
    assert clean.quality_gates(df).count() == 7
    c = clean.gate_counts(df).first()
    assert (c.removed_close, c.removed_high_low, c.kept) == (2, 1, 7)


def test_negative_volume(spark):
    rows = [("A", D(i), 1.0, 1.0, 1.0, 1.0, v) for i, v in enumerate([10**6, -100, 2 * 10**6, 0, 3 * 10**6])]
    assert clean.quality_gates(spark.createDataFrame(rows, BAR)).count() == 4


def test_gate_on_null_fails(spark):
    df = spark.createDataFrame([("A", D(0), None, 1.0, 1.0, 1.0, 1)], BAR)
    assert clean.quality_gates(df).count() == 0


def test_dedup_keeps_newest_of_many_copies(spark):
    rows = [("A", D(0), float(i), dt.datetime(2020, 1, 1, 0, i % 60, i // 60)) for i in range(500)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double, ingested_at timestamp").repartition(6)
    newest = max(rows, key=lambda r: r[3])
    out = clean.deduplicate(df).collect()
    assert len(out) == 1 and out[0].close == newest[2]


def test_nan_becomes_null(spark):
    df = clean.no_nan(spark.createDataFrame([(float("nan"),)], "x double"))
    assert value(df) is None


@pytest.mark.parametrize("prices,want", [
    ([100, 110, 120, 130, 140, 150], 0.0),
    ([100, 120, 60, 80], -0.5),
    ([100, 50, 200], -0.5),
    ([100, 80, 90, 60, 100], -0.4),
])
def test_drawdowns(spark, prices, want):
    out = risk.max_drawdown(priced(spark, prices), min_rows=1).first()
    assert out.max_drawdown == pytest.approx(want)


def test_short_series_has_no_drawdown(spark):
    assert risk.max_drawdown(priced(spark, [100, 50])).first().max_drawdown is None


@pytest.mark.parametrize("factor", [1.0, 2.0, -1.0])
def test_beta(spark, factor):
    m = [math.sin(i * 1.7) for i in range(100)]
    rows = [("S", D(i), factor * x) for i, x in enumerate(m)] + [("SPY", D(i), x) for i, x in enumerate(m)]
    df = spark.createDataFrame(rows, "ticker string, date date, daily_return double")
    out = risk.betas(df, risk.benchmark_from_bars(df)).where("ticker = 'S'").first()
    assert out.beta_static == pytest.approx(factor)
    assert out.beta_rolling_252 == pytest.approx(factor)


def test_beta_needs_sixty_shared_days(spark):
    rows = [(t, D(i), float(i % 7)) for t in ("S", "SPY") for i in range(59)]
    df = spark.createDataFrame(rows, "ticker string, date date, daily_return double")
    assert risk.beta_static(df, risk.benchmark_from_bars(df)).where("ticker = 'S'").first().beta_static is None


def test_constant_returns_have_no_sharpe(spark):
    df = spark.createDataFrame(
        [("A", D(i), 1.0, "X", 0.1) for i in range(40)],
        "ticker string, date date, close double, sector string, daily_return double")
    out = risk.add_ratios(risk.risk_base(df)).first()
    assert out.sharpe_ratio is None and out.sortino_ratio is None


def test_sma(spark):
    df = spark.createDataFrame([("A", D(i), 100.0 + 2 * i) for i in range(5)], "ticker string, date date, close double")
    got = [r.sma_3 for r in features.sma(df, (3,)).orderBy("date").collect()]
    assert got == [None, None, 102, 104, 106]


def test_rsi_first_value_on_row_fourteen(spark):
    df = spark.createDataFrame(
        [("A", D(i), 100.0 + (i % 3)) for i in range(20)], "ticker string, date date, close double")
    got = [r.rsi for r in features.rsi(df).orderBy("date").collect()]
    assert got[12] is None and got[13] is not None


def test_rsi_without_loss_is_null(spark):
    df = spark.createDataFrame([("A", D(i), 100.0 + i) for i in range(20)], "ticker string, date date, close double")
    assert all(r.rsi is None for r in features.rsi(df).collect())


def test_target_direction_of_last_row(spark):
    df = spark.createDataFrame([("A", D(0), 1.0), ("A", D(1), 2.0)], "ticker string, date date, close double")
    got = {r.date: (r.target_return, r.target_direction) for r in features.target(df).collect()}
    assert got == {D(0): (1.0, 1), D(1): (None, 0)}
    strict = {r.date: r.target_direction for r in features.target(df, keep_last=False).collect()}
    assert strict[D(1)] is None


def test_feature_list_has_33_names():
    assert len(features.feature_columns()) == 33


def test_gaps(spark):
    # Mon 6 Jan .. Fri 17 Jan 2020 without 8, 9 and 14
    days = [dt.date(2020, 1, d) for d in (6, 7, 10, 13, 15, 16, 17)]
    gaps = calendars.detect_gaps(spark.createDataFrame([(d,) for d in days], "date date"))
    got = sorted((r.gap_start.day, r.gap_end.day, r.missing_days) for r in gaps.collect())
    assert got == [(8, 9, 2), (14, 14, 1)]
    s = calendars.gap_summary(gaps).first()
    assert (s.gaps, s.span_days, s.missing_days) == (2, 3, 3)


def test_gaps_over_a_weekend_join(spark):
    days = [dt.date(2020, 1, d) for d in (9, 14)]
    gaps = calendars.detect_gaps(spark.createDataFrame([(d,) for d in days], "date date")).collect()
    assert [(g.gap_start.day, g.gap_end.day, g.missing_days) for g in gaps] == [(10, 13, 2)]


def test_vix_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 15.0, 15.1, 30.0, 100.0, 101.0)], "v double")
    assert [r[0] for r in df.select(labels.vix_bucket(F.col("v"))).collect()] == [
        None, "low_vol", "normal", "elevated", "high_vol", None]


def test_sector_names(spark):
    names = ["Technology", " BANKS ", "Information Technology", "Oil & Gas", "Health Care", "Zoo", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    assert [r[0] for r in df.select(labels.standardize_sector(F.col("s"))).collect()] == [
        "Technology", "Financials", "Technology", "Energy", "Healthcare", "Unknown", "Unknown"]


def test_text(spark):
    df = spark.createDataFrame([("<b>Buy</b> $F & TSLA​ now—CEO of AAPL1, ÉABC MSFT!",), (None,)], "t string")
    a, b = df.select(text.clean_text(F.col("t"))).collect()
    assert a[0] == "Buy F TSLA now CEO of AAPL1, ÉABC MSFT!" and b[0] == ""
    a, b = df.select(text.extract_tickers(F.col("t"))).collect()
    assert a[0] == ["F", "MSFT", "TSLA"] and b[0] == []


def test_parse_tickers(spark):
    raw = ['["aapl", " msft ", ""]', "aapl, Msft,,", "[broken", '{"a": 1}', None, "[]"]
    df = spark.createDataFrame([(r,) for r in raw], "t string")
    assert [r[0] for r in df.select(text.parse_tickers(F.col("t"))).collect()] == [
        ["AAPL", "MSFT"], ["AAPL", "MSFT"], ["[BROKEN"], [], [], []]


def test_hash_sector_equals_big_integer(spark):
    import hashlib

    names = [f"T{i}" for i in range(50)]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    got = [r[0] for r in df.select(labels.hash_sector(F.col("t"))).collect()]
    assert got == [labels.VALID_SECTORS[int(hashlib.md5(n.encode()).hexdigest(), 16) % 10] for n in names]


def test_contract_examples_are_bounded(spark):
    from dataclasses import replace

    c = replace(CONTRACTS["bronze_market_news"], allowed={"sentiment_label": ("positive",)})
    df = spark.createDataFrame([(f"n{i}", None, f"bad{i:03d}") for i in range(200)],
                               "news_id string, title string, sentiment_label string")
    rows = {(r.issue, r.column): r for r in quality.validate_contract(df, c).collect()}
    assert rows[("value_not_allowed", "sentiment_label")].examples == [f"bad{i:03d}" for i in range(5)]
    assert rows[("value_not_allowed", "sentiment_label")]["count"] == 200
    assert rows[("null", "title")]["count"] == 200
    assert ("missing_column", "content") in rows


def test_valid_bars_have_no_violation(spark):
    df = spark.createDataFrame([("A", D(0), 1.0, 1.0, 1.0, 1.0, 1)], BAR)
    assert quality.validate_bars(df).count() == 0


def test_clip_mode(spark):
    df = spark.createDataFrame([(0.0, 5.0, 0.2)], "last_price double, daily_return double, max_drawdown double")
    assert tuple(quality.clean_metrics(df, "clip").first()) == (None, 1.0, -0.2)


def test_total_loss_makes_product_zero(spark):
    df = spark.createDataFrame(
        [("A", D(i), 10.0, "X", r) for i, r in enumerate([0.0, -100.0, 5.0])],
        "ticker string, date date, close double, sector string, daily_return double")
    assert sectors.sector_metrics(df).first().total_return == -100


def test_portfolio_value_two_periods(spark):
    px = {"A": [100, 110, 120, 60], "B": [50, 50, 100, 100]}
    days = [dt.date(2020, 1, 30), dt.date(2020, 1, 31), dt.date(2020, 2, 3), dt.date(2020, 2, 4)]
    df = spark.createDataFrame(
        [(t, d, float(v)) for t, vs in px.items() for d, v in zip(days, vs)],
        "ticker string, date date, close double")
    dates = performance.rebalance_dates(df.select("date"))
    assert sorted(r.date for r in dates.collect()) == [days[0], days[2]]
    targets = performance.equal_weight_targets(df, dates)
    got = {r.date: r.total_value for r in performance.portfolio_value(df, targets, 1000, 0.001, 0.0).collect()}
    start = 1000 * (1 - 0.001)                      # buying everything
    assert got[days[0]] == pytest.approx(start)
    assert got[days[1]] == pytest.approx(start * (0.5 * 1.1 + 0.5))
    grown = start * (0.5 * 1.2 + 0.5 * 2.0)
    drift = 0.5 * 1.2 / 1.6
    paid = grown * (1 - 0.001 * 2 * abs(0.5 - drift))
    assert got[days[2]] == pytest.approx(paid)
    assert got[days[3]] == pytest.approx(paid * (0.5 * 0.5 + 0.5))


def test_unpriced_holdings_stay_in_cash(spark):
    days = [dt.date(2020, 1, 2), dt.date(2020, 1, 3), dt.date(2020, 1, 6), dt.date(2020, 1, 7)]
    px = {"A": [100, 110, 121, 133.1], "Z": [0, 5, 10, 10], "N": [None, 4, 4, 4], "G": [10, None, float("nan"), 20]}
    df = spark.createDataFrame(
        [(t, d, None if v is None else float(v)) for t, vs in px.items() for d, v in zip(days, vs)],
        "ticker string, date date, close double")
    # the second rebalance falls on a day without bars, and names one ticker twice
    sunday = dt.date(2020, 1, 5)
    targets = spark.createDataFrame(
        [(days[0], t, 0.25) for t in "AZNG"] + [(sunday, "A", 0.5), (days[2], "A", 0.5), (days[2], "A", 0.25),
         (days[2], "Z", None), (None, "A", 1.0)], "date date, ticker string, weight double")
    held = performance.segments(df, targets)
    assert {tuple(r) for r in performance.unpriced_holdings(held).collect()} == {
        (days[0], "Z", 0.25), (days[0], "N", 0.25), (sunday, "A", 0.5)}
    got = {(r.start, r.date): r.growth for r in performance.period_values(df, targets, held).collect()}
    assert got == pytest.approx({
        (days[0], days[0]): 1.0, (days[0], days[1]): 0.25 * 1.1 + 0.75, (days[0], sunday): 0.25 * 1.1 + 0.75,
        (sunday, sunday): 0.5, (sunday, days[2]): 0.5, (days[2], days[2]): 0.75, (days[2], days[3]): 0.825})
    moves = {(r.date, r.ticker): (r.old, r.new) for r in performance.rebalance_moves(df, targets, held).collect()}
    worth = 0.25 * 1.1 + 0.75
    assert moves == {
        (days[0], "A"): (0.0, 0.25), (days[0], "G"): (0.0, 0.25), (sunday, "A"): (pytest.approx(0.275 / worth), 0.0),
        (sunday, "G"): (pytest.approx(0.25 / worth), 0.0), (days[2], "A"): (0.0, 0.75), (days[2], "Z"): (0.0, 0.0)}
    none = performance.segments(df, targets.limit(0))
    assert none.count() == 0 and performance.rebalance_moves(df, targets, none).count() == 0


def test_the_benchmark_itself_has_no_low_beta(spark):
    cand = spark.createDataFrame(
        [("SPY", 1 - 1e-15, 0.3), ("A", 0.9, 0.2), ("B", 1.1, 0.9)], "ticker string, beta double, return_stability double")
    assert [r.ticker for r in portfolios.low_beta_select(cand).collect()] == ["A"]


def test_treatment_p_value(spark):
    rows = [(float(i), 1.0 + (i % 5) * 0.1 + (2.0 if i >= 50 else 0.0)) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, y double")
    out = models.treatment_test(df, ["x"], "y").first()
    assert out.effect == pytest.approx(2.0) and out.significant and out.p_value < 1e-20
    few = models.treatment_test(df.limit(8), ["x"], "y").first()
    assert few.p_value == 0.5 and few.t_value is None


def test_importance_finds_the_planted_feature(spark):
    rows = [(float(i % 17), float((i * 7) % 13), int((i * 7) % 13 > 6)) for i in range(400)]
    df = spark.createDataFrame(rows, "noise double, signal double, target_direction int")
    out = models.feature_importance(df, ["noise", "signal"], trees=10, depth=4).collect()
    assert [(r.feature, r["rank"]) for r in out] == [("signal", 1), ("noise", 2)]


def test_adjusted_effect(spark):
    rows = [(float(i % 7), float(i % 11), 3.0 * (i % 7) - 2.0 * (i % 11)) for i in range(154)]
    df = spark.createDataFrame(rows, "t double, c double, y double")
    out = models.ate(df, "t", "y", ["c"]).first()
    assert out.adjusted_ate == pytest.approx(3.0)


def test_duplicate_rows_of_any_width(spark):
    """All columns count, long texts and nested values too, whatever the hashes do."""
    from tapeloom.operators import quality

    long = "x" * 100_000
    rows = [(1, None, long, 0.0, [1, 2]), (1, None, long, -0.0, [1, 2]), (1, None, long + "y", 0.0, [1, 2]), (None, 1, long, 0.0, [1, 2]),
            (1, None, long, 0.0, [1, None]), (None, None, None, None, None), (None, None, None, None, None), (2, 12, "a", float("nan"), []),
            (2, 12, "a", float("nan"), []), (21, 2, "a", float("nan"), []), (2, 1, "2a", 1.0, None)]
    df = spark.createDataFrame(rows, "a int, b int, t string, v double, l array<int>").withColumn("m", F.create_map(F.lit("k"), "a"))
    want = (len(rows), 8)
    assert tuple(quality.row_counts(df).first()) == want
    for forced in ([F.lit(1), F.lit(2)], [F.col("a") % 2, F.lit(0)], [F.coalesce("a", F.lit(7)), F.coalesce("b", F.lit(7))]):
        assert tuple(quality.row_counts(df.where("a is not null"), forced).first()) == (8, 6)
    assert tuple(quality.row_counts(df.limit(0)).first()) == (0, 0)
    keyed = quality.duplicate_counts(df.drop("l", "m"), ["a", "b"]).first()
    assert tuple(keyed) == (4, 5)


def test_whole_rows_are_not_shuffled(spark):
    from tapeloom.operators import quality

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quality.row_counts(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for keys in __import__("re").findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
        assert "text" not in keys
    assert "text" not in "".join(line for line in plan.splitlines() if "HashAggregate" in line)


def test_profile_counts_nulls_by_column(spark):
    from tapeloom.operators import quality

    df = spark.createDataFrame([("A", None, 1.0), ("A", None, 1.0), (None, None, 2.0)], "ticker string, x int, v double")
    row = quality.profile(df, "l", "s").first()
    assert row["null_counts"] == {"ticker": 1, "x": 3, "v": 0} and row["total_nulls"] == 4
    assert (row["row_count"], row["duplicate_rows"], row["ticker_count"]) == (3, 1, 1)
    assert quality.profile(df.limit(0), "l", "s").first()["duplicate_rows"] == 0


def test_contracts_take_typed_columns():
    from tapeloom.contracts import TableContract

    with pytest.raises(TypeError):
        TableContract("t", "date date!, ticker str!", ("date",))


def test_merged_risk_equals_single_metrics(spark):
    """Years merge to what the metrics give over whole series, with gaps, constants and short series."""
    import random

    rnd = random.Random(4)
    rows = []
    for t, n, sector in (("SPY", 900, "Fund"), ("A", 900, "X"), ("B", 400, None), ("C", 70, "X"), ("D", 31, "Y"), ("E", 5, "Z"), ("F", 1, None)):
        price = 100.0
        for i in range(n):
            r = None if rnd.random() < 0.03 else rnd.gauss(0.05, 2)
            price *= 1 + (r or 0) / 100
            day = dt.date(2015, 1, 1) + dt.timedelta(days=i + (200 if t == "B" else 0))
            rows.append((t, day, None if rnd.random() < 0.05 else price, r, sector if rnd.random() < 0.9 else "W"))
    rows += [("G", dt.date(2015, 1, 1) + dt.timedelta(days=i), 10.0, 0.0, "X") for i in range(100)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double, daily_return double, sector string")
    bench = risk.benchmark_from_bars(df)
    merged = {r["ticker"]: r.asDict() for r in risk.merge_summaries(risk.slice_summaries(df, bench)).collect()}
    base = {r["ticker"]: r.asDict() for r in risk.risk_base(df).collect()}
    falls = {r["ticker"]: r["max_drawdown"] for r in risk.max_drawdown(df, min_rows=1).collect()}
    static = {r["ticker"]: r.asDict() for r in risk.beta_static(df, bench, 1).collect()}
    recent = {r["ticker"]: r.asDict() for r in risk.beta_trailing(df, bench).collect()}
    assert merged.keys() == base.keys() and len(merged) == 8

    def close(a, b):
        return a == b if a is None or b is None or not isinstance(a, float) else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)

    for t, m in merged.items():
        for c, v in base[t].items():
            assert close(m[c], v), (t, c, m[c], v)
        assert close(m["max_drawdown"], falls.get(t)) and close(m["slope"], static[t]["beta_static"])
        assert m["shared"] == static[t]["shared"] and m["recent"] == recent[t]["recent"]
        assert close(m["beta_recent"], recent[t]["beta_recent"])
    flat = spark.createDataFrame([(t, dt.date(2015 + i % 2, 1, 1) + dt.timedelta(days=i), 1.0, 0.3, "X") for t in ("SPY", "A") for i in range(90)],
                                 df.schema)
    rows = risk.merge_summaries(risk.slice_summaries(flat, risk.benchmark_from_bars(flat))).collect()
    assert [r["slope"] for r in rows] == [None, None]
    assert risk.risk_metrics(df.limit(0)).collect() == []


@pytest.mark.parametrize("t, freedom, p", [
    (0.0, 5, 1.0), (2.0, 1, 0.29516723530086653), (2.0, 10, 0.07338803477074071), (-1.96, 1000, 0.05027318495575),
    (12.0, 30, 5.580185415199218e-13), (1e-9, 3, 0.9999999992648941), (3.5, 2_000_000, 0.000465268275467)])
def test_student(t, freedom, p):
    """Against the density, integrated numerically."""
    assert math.isclose(models.two_sided_p(t, freedom), p, rel_tol=1e-8)


def test_slopes_of_all_treatments_in_one_pass(spark):
    import random

    import numpy as np

    rnd = random.Random(2)
    rows = []
    for _ in range(300):
        a, b = rnd.gauss(5, 2), rnd.gauss(-1, 1)
        c = 0.3 * a + rnd.gauss(0, 1)
        rows.append((a if rnd.random() < 0.9 else None, b, c if rnd.random() < 0.95 else None, 1.0, 2 * a - b + 0.5 * c + rnd.gauss(0, 1)))
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, y double").repartition(5)
    out = {r["treatment"]: r for r in models.ate_all(df, ["a", "b", "c", "k"], "y", ["a", "c"]).collect()}

    def want(columns):
        full = [r for r in rows if all(r["abck".index(x)] is not None for x in columns)]
        x = np.array([[1.0, *[r["abck".index(c)] for c in columns]] for r in full])
        return np.linalg.lstsq(x, np.array([r[4] for r in full]), rcond=None)[0][1]

    for t in "abc":
        assert math.isclose(out[t]["raw_ate"], want([t]), rel_tol=1e-9)
        assert math.isclose(out[t]["adjusted_ate"], want([t, *[c for c in "ac" if c != t]]), rel_tol=1e-9)
    assert out["k"]["raw_ate"] is None and out["k"]["adjusted_ate"] is None  # a constant has no effect to tell
    empty = models.ate(df.limit(0), "a", "y").first()
    assert empty["raw_ate"] is None


def test_many_splits_of_one_ticker(spark):
    """Against a plain loop: thousands of splits, two on one day, a split on a bar's day, other tickers, gaps of years."""
    rnd = random.Random(5)
    first = dt.date(2000, 1, 1)
    splits = [("A", first + dt.timedelta(days=rnd.randrange(5000)), rnd.choice([0.5, 2.0])) for _ in range(3000)]
    splits += [("B", first, 4.0), ("B", first + dt.timedelta(days=4000), 2.0), ("B", None, 9.0), (None, first, 9.0), ("B", first, None)]
    bars = [(t, first + dt.timedelta(days=d), 8.0) for t in ("A", "B", "C") for d in range(0, 5200, 13)] + [("A", None, 3.0), (None, first, 3.0)]
    got = quality.adjust_splits(spark.createDataFrame(bars, "ticker string, date date, price double"),
                                spark.createDataFrame(splits, "ticker string, split_date date, ratio double"))
    assert got.columns == ["ticker", "date", "price"]
    out = {(r["ticker"], r["date"]): r["price"] for r in got.collect()}
    assert len(out) == len(bars)
    for t, d, p in bars:
        factor = math.prod(r for s, x, r in splits if s == t and s and x and d and r and x > d)
        assert out[(t, d)] == pytest.approx(p / factor, rel=1e-12)


def test_a_forest_reads_few_partitions(spark, monkeypatch):
    """The sums that a partition sends in a round do not shrink with it."""
    read, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: read.append(df.rdd.getNumPartitions()) or fit(self, df))
    most = 4 * spark.sparkContext.defaultParallelism
    df = spark.range(0, 4000, 1, 3 * most).select(
        (F.col("id") % 17).cast("double").alias("noise"), (F.col("id") * 7 % 13).cast("double").alias("signal"),
        (F.col("id") * 7 % 13 > 6).cast("int").alias("target_direction"))
    out = models.feature_importance(df, ["noise", "signal"], trees=5, depth=3).collect()
    assert out[0].feature == "signal" and read == [most]
