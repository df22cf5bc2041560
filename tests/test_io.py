"""Sources, sinks, snapshots and streams on small files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.clean import refresh_prices
from tapeloom.sources import payloads, readers, sinks, snapshots
from tapeloom.streaming import bars as live
from tapeloom.streaming import refresh

KV = "id bigint, value string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshot_life(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], KV)
    b = spark.createDataFrame([(4, "d"), (5, "e"), (6, "f")], KV)
    assert not snapshots.is_snapshot(spark, path)
    assert snapshots.write_snapshot(a, path) == 0
    assert snapshots.write_snapshot(b, path, "append") == 1
    assert rows(snapshots.read_snapshot(spark, path)) == rows(b)
    assert rows(snapshots.read_snapshot(spark, path, 0)) == rows(a)
    assert rows(snapshots.read_snapshot(spark, path, read="all")) == rows(a.union(b))
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, path, 7)
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, str(tmp_path / "none"))
    assert snapshots.write_snapshot(a, path) == 2
    assert rows(snapshots.read_snapshot(spark, path, read="all")) == rows(a)
    assert [r.version for r in snapshots.snapshot_history(spark, path, 2).collect()] == [2, 1]
    assert snapshots.write_snapshot(b, path, keep_history=False) == 0
    assert snapshots.snapshot_info(spark, path).first().versions == 1


def test_whole_texts_by_file_stem(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.note.txt").write_text("été")
    assert rows(readers.read_text_documents(spark, str(tmp_path))) == [("a", "one\ntwo"), ("b.note", "été")]


def test_ticker_sample_is_whole_and_stable(spark):
    df = spark.createDataFrame([(f"T{i % 9}", i) for i in range(90)], "ticker string, n int")
    a = rows(readers.sample_tickers(df, 4))
    assert a == rows(readers.sample_tickers(df.repartition(7), 4)) and len(a) == 40
    assert len({t for t, _ in a}) == 4
    assert a != rows(readers.sample_tickers(df, 4, seed=7)) or a != rows(readers.sample_tickers(df, 4, seed=8))


def test_json_array_file(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"id": 1, "value": "a"}, {"id": 2, "value": "b"}]))
    assert rows(readers.read_json_records(spark, str(tmp_path), KV)) == [(1, "a"), (2, "b")]


def test_partition_pruning_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame(
        [("A", dt.date(2020, 1, d), 1.0, 1.0, 1.0, float(d), 1) for d in range(1, 6)],
        "ticker string, date date, open double, high double, low double, close double, volume bigint")
    sinks.write_by_date(df, path)
    sinks.write_by_date(df.where("date = '2020-01-02'").withColumn("close", F.lit(9.0)), path)
    out = readers.read_bars(spark, path, start="2020-01-02", end="2020-01-03")
    assert sorted(r.close for r in out.collect()) == [3.0, 9.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert spark.read.parquet(path).count() == 5


def test_pushdown(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.createDataFrame([("A", dt.date(2020, 1, 1), 1.0, 5)], "Ticker string, Date date, Close double, X int").write.parquet(path)
    plan = readers.read_bars(spark, path, start="2020-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2020-01-01)" in plan and "X" not in plan.split("ReadSchema")[1]


def test_bad_payloads_give_no_rows(spark):
    df = spark.createDataFrame([("{broken", "DFF"), (None, "DFF"), ("{}", "DFF")], "payload string, indicator_id string")
    assert payloads.flatten_observations(df).count() == 0
    for kind in ("archive", "market", "articles"):
        assert payloads.flatten_news_payload(df, kind).count() == 0


def test_observation_values(spark):
    obs = {"observations": [{"date": "2020-01-01", "value": "."}, {"date": "2020-01-02", "value": "1.5"},
                            {"date": "2020-01-03", "value": "x"}]}
    df = spark.createDataFrame([(json.dumps(obs), "DFF")], "payload string, indicator_id string")
    assert rows(payloads.flatten_observations(df)) == [(dt.date(2020, 1, 2), "DFF", 1.5)]


def test_published_table_absent_then_present(spark, tmp_path):
    pub = sinks.Publisher(spark, str(tmp_path / "pub"))
    assert pub.load_published("x", KV).count() == 0
    pub.publish("x", spark.createDataFrame([(1, "a")], KV), batch_date=dt.date(2020, 1, 1))
    assert rows(pub.load_published("x", KV)) == [(1, "a")]
    f = sinks.freshness(pub.manifest(), "2020-01-02 00:00:00").first()
    assert (f.age_days, f.is_valid) == (1, True)
    assert sinks.freshness(pub.manifest(), "2020-01-03 00:00:00").first().is_valid is False


TICK = "event_id bigint, ticker string, ts timestamp, price double, size bigint"


def tick(i, ticker, minute, price):
    return (i, ticker, dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=minute), price, 1)


def land(spark, path, batch, n):
    spark.createDataFrame(batch, TICK).coalesce(1).write.mode("append").parquet(f"{path}/b{n}")


def stream(spark, path):
    return spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_stream_equals_batch_over_several_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    batches = [
        [tick(1, "A", 0, 10.0), tick(2, "A", 1, 12.0), tick(3, "B", 2, 5.0)],
        [tick(2, "A", 1, 12.0), tick(4, "A", 4, 9.0), tick(5, "A", 6, 11.0)],  # 2 again
        [tick(6, "B", 7, 6.0), tick(7, "B", 14, 7.0)],
    ]
    pub = sinks.Publisher(spark, str(tmp_path / "pub"))
    schema = ("bar_start timestamp, bar_end timestamp, ticker string, open double, high double, low double, "
              "close double, volume bigint")

    def step(batch, batch_id):
        pub.publish("bars", sinks.upsert_by_key(pub.load_published("bars", schema), batch, ["bar_start", "ticker"]))

    for n, b in enumerate(batches):
        land(spark, src, b, n)
        live.for_each_batch(live.stream_bars(stream(spark, src)), step, str(tmp_path / "ck"), mode="update").awaitTermination()
    want = live.stream_bars(spark.createDataFrame([t for b in batches for t in b], TICK))
    assert rows(pub.load_published("bars", schema)) == rows(want)
    first = [r for r in rows(want) if r[2] == "A"][0]
    assert first[3:] == (10.0, 12.0, 9.0, 9.0, 3)


def test_late_tick_is_left_out(spark, tmp_path):
    src = str(tmp_path / "src")
    pub = sinks.Publisher(spark, str(tmp_path / "pub"))
    schema = "bar_start timestamp, bar_end timestamp, ticker string, open double, high double, low double, close double, volume bigint"

    def step(batch, batch_id):
        pub.publish("bars", sinks.upsert_by_key(pub.load_published("bars", schema), batch, ["bar_start", "ticker"]))

    for n, b in enumerate([[tick(1, "A", 0, 1.0)], [tick(2, "A", 60, 2.0)], [tick(3, "A", 70, 2.0)], [tick(4, "A", 1, 99.0)]]):
        land(spark, src, b, n)
        live.for_each_batch(live.stream_bars(stream(spark, src)), step, str(tmp_path / "ck"), mode="update").awaitTermination()
    assert 99.0 not in [r.high for r in pub.load_published("bars", schema).collect()]


def test_gold_waits_for_silver(spark):
    calls = []
    step = refresh.layered(lambda b, i: calls.append("silver") or b, lambda b, i: calls.append("gold"))
    step(spark.createDataFrame([], KV), 0)
    assert calls == []
    step(spark.createDataFrame([(1, "a")], KV), 1)
    assert calls == ["silver", "gold"]

    def broken(b, i):
        raise RuntimeError("silver failed")

    with pytest.raises(RuntimeError):
        refresh.layered(broken, lambda b, i: calls.append("gold"))(spark.createDataFrame([(1, "a")], KV), 2)
    assert calls == ["silver", "gold"]


def test_pnl_step_twice_is_the_same(spark, tmp_path):
    pub = sinks.Publisher(spark, str(tmp_path / "pub"))
    weights = spark.createDataFrame([("s", "A", 0.5), ("s", "B", 0.5)], "strategy string, ticker string, weight double")
    day = spark.createDataFrame([("A", dt.date(2020, 1, 1), 2.0), ("B", dt.date(2020, 1, 1), 4.0)],
                                "ticker string, date date, daily_return double")
    step = refresh.pnl_step(pub, weights)
    step(day, 0)
    step(day, 0)
    out = pub.load_published("performance", "").collect()
    assert [(r.date, r.strategy, round(r.daily_return, 9), r.holdings) for r in out] == [(dt.date(2020, 1, 1), "s", 0.03, 2)]


def test_refresh_keeps_old_price(spark):
    old = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "ticker string, last_price double")
    new = spark.createDataFrame([("B", 3.0)], "ticker string, last_price double")
    out = {r.ticker: (r.last_price, r.updated_at is not None) for r in refresh_prices(old, new).collect()}
    assert out == {"A": (1.0, False), "B": (3.0, True)}


def test_big_dates_are_dealt_over_files(spark, tmp_path):
    from tapeloom.sources import sinks

    rows = [("2020-01-01", f"T{i % 3}", float(i)) for i in range(500)] + [("2020-01-02", "T1", 1.0), (None, "T1", 2.0)]
    df = spark.createDataFrame(rows, "date string, ticker string, close double").withColumn("date", F.col("date").cast("date"))
    path = str(tmp_path / "days")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few bytes would be joined into one task
    try:
        sinks.write_by_date(df, path, rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "days").iterdir() if d.is_dir()}
    assert files["date=2020-01-01"] >= 3 and files["date=2020-01-02"] == 1
    assert spark.read.parquet(path).count() == len(rows)


def test_wide_tables_have_as_many_columns_for_any_number_of_tickers(spark):
    from pyspark.sql import functions as F

    from tapeloom.sources import readers

    long = spark.range(700).select(
        F.when(F.col("id") % 70 > 0, F.concat(F.lit("T"), (F.col("id") % 70).cast("string"))).alias("ticker"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 70).cast("int")).alias("date"),
        F.when(F.col("id") % 9 > 0, F.col("id") * 1.5).alias("close"), F.col("id").alias("volume"))
    wide, places = readers.widen_bars(long, ("close", "volume"), width=8)
    assert len(places) == 8 and len(wide.columns) == 25
    back = readers.unpivot_bars(wide, places, ("close", "volume"))
    assert back.columns == ["date", "ticker", "close", "volume"]
    key = lambda r: (r["date"], r["ticker"] or "", r["close"], r["volume"])
    assert sorted(map(key, back.collect()), key=str) == sorted(map(key, long.collect()), key=str)
