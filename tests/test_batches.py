"""Streams cut into several batches, snapshots that shrink, and edge values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import performance, quality, quantiles, timeblocks
from tapeloom.sources import readers, snapshots
from tapeloom.sources.sinks import Publisher
from tapeloom.streaming import refresh

TICK = "event_id bigint, ticker string, ts timestamp, price double, size bigint"


def at(hour, minute=0):
    return datetime(2024, 1, 2, hour, minute)


def test_pnl_of_a_day_in_two_batches(spark, tmp_path):
    weights = spark.createDataFrame([("s", "A", 0.5), ("s", "B", 0.5)], "strategy string, ticker string, weight double")
    pub = Publisher(spark, str(tmp_path))
    step = refresh.pnl_step(pub, weights)
    day = date(2024, 1, 2)
    a = spark.createDataFrame([("A", day, 10.0)], "ticker string, date date, daily_return double")
    b = spark.createDataFrame([("B", day, 10.0)], "ticker string, date date, daily_return double")
    for batch, number in ((a, 0), (b, 1), (b, 1)):
        step(batch, number)
    got = pub.load_published("performance", "").collect()
    assert [(r["daily_return"], r["holdings"]) for r in got] == [(pytest.approx(0.10), 2)]


def test_late_ticks_do_not_move_prices_back(spark, tmp_path):
    pub = Publisher(spark, str(tmp_path))
    base = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "ticker string, last_price double")
    pub.publish("risk_metrics", base)
    step = refresh.refresh_step(pub, base.schema)
    for n, rows in enumerate([[(1, "A", at(11), 20.0, 1)], [(2, "A", at(10), 15.0, 1), (3, "B", at(9), 3.0, 1)]]):
        step(spark.createDataFrame(rows, TICK), n)
    got = {r["ticker"]: (r["last_price"], r["updated_at"]) for r in pub.load_published("risk_metrics", base.schema).collect()}
    assert got == {"A": (20.0, at(11)), "B": (3.0, at(9))}


def test_a_bar_cut_across_batches(spark, tmp_path):
    pub = Publisher(spark, str(tmp_path / "tables"))
    step = refresh.bars_step(pub, str(tmp_path / "bronze"))
    first = spark.createDataFrame([(1, "A", at(10, 0), 20.0, 1), (9, "B", at(12), 5.0, 7)], TICK)
    second = spark.createDataFrame([(2, "A", at(10, 1), 15.0, 1), (1, "A", at(10, 0), 20.0, 1)], TICK)
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        out = step(batch, number)
    got = {r["ticker"]: (r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in out.collect()}
    assert got == {"A": (20.0, 20.0, 15.0, 15.0, 2), "B": (5.0, 5.0, 5.0, 5.0, 7)}


def test_overwritten_partitions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "d string, v bigint")
    for _ in range(2):
        snapshots.write_snapshot(two, path, keep_history=False, partition_by=("d",))
    assert snapshots.write_snapshot(two.where("d = 'a'"), path, keep_history=False, partition_by=("d",)) == 0
    assert [tuple(r) for r in snapshots.read_snapshot(spark, path).select("d", "v").collect()] == [("a", 1)]
    assert snapshots.write_snapshot(two.where("d = 'b'"), path, mode="append", partition_by=("d",)) == 1
    assert snapshots.read_snapshot(spark, path, read="all").count() == 2
    assert [r["version"] for r in snapshots.snapshot_history(spark, path).collect()] == [1, 0]


def test_second_writer_of_a_version_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(3)
    snapshots.write_snapshot(df, path)
    monkeypatch.setattr(snapshots, "current_version", lambda *a: None)  # as if it had looked before the first wrote
    with pytest.raises(Exception, match="(?i)exists"):
        snapshots.write_snapshot(df, path)
    monkeypatch.undo()
    assert snapshots.read_snapshot(spark, path).count() == 3


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(3), path)
    with pytest.raises(Exception):
        snapshots.write_snapshot(spark.range(1).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert snapshots.read_snapshot(spark, path).count() == 3
    assert snapshots.write_snapshot(spark.range(5), path) == 1
    assert snapshots.read_snapshot(spark, path).count() == 5


def test_edge_values(spark):
    day = lambda i: date(2020 + i, 1, 1)
    series = spark.createDataFrame(
        [(None, day(0), 1.0), (None, day(1), 2.0), ("A", day(0), 0.0), ("A", day(1), 3.0)], "ticker string, date date, close double")
    rows = {(r["ticker"], r["date"]): r[timeblocks.ROW] for r in timeblocks.row_numbers(series, ["ticker"], ["date"]).collect()}
    assert rows[(None, day(1))] == 2 and rows[("A", day(1))] == 2
    falls = timeblocks.drawdown_by(series.where("ticker = 'A'"), ["ticker"], "date", "close").collect()
    assert falls[0]["max_drawdown"] == 0.0
    inf = float("inf")
    values = spark.createDataFrame([("g", v) for v in (1.0, 2.0, inf, -inf, 3.0)], "k string, v double")
    got = quantiles.quantiles(values, ["k"], {"mid": ("v", 0.5), "top": ("v", 1.0)}).first()
    assert (got["mid"], got["top"]) == (2.0, inf)
    bare = spark.createDataFrame([("x",)], "name string")
    assert quality.range_violations(bare).count() == quality.sign_violations(bare).count() == 0
    assert quality.validation_report(bare).first()["is_valid"]


def test_newest_row_of_a_source(spark):
    df = spark.createDataFrame([("A", date(2024, 1, 1), 1.0, 1), ("A", date(2024, 1, 1), 2.0, 2)],
                               "ticker string, date date, close double, seen int")
    assert readers.coalesce_sources([(1, df)], F.col("seen")).first()["close"] == 2.0


def test_rebalance_frequencies(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-03', date'2024-02-10')) AS date")
    got = {f: performance.rebalance_dates(days, f).count() for f in ("daily", "weekly", "monthly")}
    assert got == {"daily": 39, "weekly": 6, "monthly": 2}
    with pytest.raises(ValueError):
        performance.rebalance_dates(days, "yearly")
