"""Tables in parts under a stream, and commits of several writers."""

import os
import threading
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapeloom.sources import commits, snapshots
from tapeloom.sources.partitions import PartitionedTable, by_day, by_hash
from tapeloom.sources.sinks import Publisher
from tapeloom.streaming import refresh

DAYS = "date date, ticker string, v double"


def days(spark, *rows):
    return spark.createDataFrame([(date(2024, 1, d), t, float(v)) for d, t, v in rows], DAYS)


def files(path):
    return {os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def content(table, version=None):
    return sorted((r["date"].day, r["ticker"], r["v"]) for r in table.read(version).collect())


def test_a_batch_writes_only_its_days(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), DAYS, ["date", "ticker"], by_day("date"), full_every=1000)
    want, sizes = {}, []
    for n in range(20):
        before = files(tmp_path / "data")
        day = n + 1
        rows = [(day, "A", n), (day, "B", n)] + ([(day - 1, "B", -n)] if n else [])
        assert table.upsert(days(spark, *rows)) == [f"2024-01-{d:02d}" for d in sorted({r[0] for r in rows})]
        want |= {r[:2]: float(r[2]) for r in rows}
        sizes.append(len(files(tmp_path / "data") - before))
    assert sizes == [1] + [2] * 19
    assert content(table) == sorted((*k, v) for k, v in want.items())
    assert [v for *_, v in content(table, 0)] == [0.0, 0.0]  # an older version


def test_repeated_batches_and_null_keys_change_nothing(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), DAYS, ["date", "ticker"], by_day("date"))
    rows = spark.createDataFrame([(None, "A", 1.0), (date(2024, 1, 1), None, 2.0), (date(2024, 1, 1), "A", None)], DAYS)
    for _ in range(3):
        assert table.upsert(rows) == ["2024-01-01", "none"]
    assert table.read().count() == 3
    assert table.upsert(rows.limit(0)) == []
    assert table.versions() == {0: True, 1: False, 2: False}
    with pytest.raises(ValueError):
        table.read(9)


def test_old_versions_go_and_kept_ones_stay_whole(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), DAYS, ["date", "ticker"], by_day("date"), full_every=4, keep=3)
    states = {}
    for n in range(13):
        table.upsert(days(spark, (n % 5 + 1, "A", n)))
        states[n] = content(table)
    assert max(table.versions()) == 12 and min(table.versions()) > 4
    for v in table.versions():
        assert content(table, v) == states[v]
    assert len(files(tmp_path / "data")) <= 5 + 9  # the live parts and what kept versions replaced


def test_a_large_part_takes_several_files(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "k bigint, v bigint", ["k"], by_hash("k", 1), rows_per_file=100)
    table.upsert(spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v")))
    assert len(files(tmp_path / "data")) > 3
    table.upsert(spark.range(10).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v")))
    assert table.read().agg(F.count("*"), F.count_if(F.col("v") == -1)).first()[:] == (1000, 10)


def race(writers):
    """Run the writers in threads; what each returned or raised."""
    out = {}

    def run(n, writer):
        try:
            out[n] = writer()
        except Exception as error:  # noqa: BLE001
            out[n] = error

    threads = [threading.Thread(target=run, args=(n, w)) for n, w in enumerate(writers)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return list(out.values())


@pytest.fixture
def together(monkeypatch):
    """Both writers reach their claim before either makes it."""
    gate = threading.Barrier(2, timeout=60)
    real = commits.claim

    def claim(*args):
        gate.wait()
        real(*args)

    def use(module):
        monkeypatch.setattr(module, "claim", claim)

    return use


def test_one_of_two_snapshot_writers_is_refused(spark, tmp_path, together):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(1), path)
    together(snapshots)
    got = race([lambda: snapshots.write_snapshot(spark.range(10), path, "append"),
                lambda: snapshots.write_snapshot(spark.range(10), path, "append")])
    assert sorted(type(g).__name__ for g in got) == ["FileExistsError", "int"]
    assert snapshots.read_snapshot(spark, path, read="all").count() == 11
    assert len([d for d in os.listdir(tmp_path / "t/data")]) == 2  # the refused folder is gone


def test_one_of_two_part_writers_is_refused(spark, tmp_path, together):
    from tapeloom.sources import partitions

    table = PartitionedTable(spark, str(tmp_path), DAYS, ["date", "ticker"], by_day("date"))
    table.upsert(days(spark, (1, "A", 0)))
    together(partitions)
    got = race([lambda d=d: table.upsert(days(spark, (d, "A", d))) for d in (2, 3)])
    assert sorted(type(g).__name__ for g in got) == ["FileExistsError", "list"]
    assert len(content(table)) == 2


def test_a_writer_that_died_after_its_claim_blocks_nobody_for_long(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(1), path)
    commits.claim(spark, f"{path}/claims", "0-1")
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(spark.range(2), path)
    monkeypatch.setattr(snapshots, "ABANDONED", -10.0)
    assert snapshots.write_snapshot(spark.range(2), path) == 2
    assert snapshots.read_snapshot(spark, path).count() == 2


def test_expired_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, mode in enumerate(["overwrite", "overwrite", "append", "overwrite", "append"]):
        snapshots.write_snapshot(spark.range(n + 1), path, mode)
    assert snapshots.expire_snapshots(spark, path, keep=1) == [0, 1, 2]
    assert snapshots.read_snapshot(spark, path, read="all").count() == 4 + 5
    assert snapshots.snapshot_info(spark, path).first()["versions"] == 2
    assert snapshots.expire_snapshots(spark, path, keep=1) == []


def test_price_refresh_rewrites_parts_of_its_tickers(spark, tmp_path):
    pub = Publisher(spark, str(tmp_path))
    base = spark.createDataFrame([(f"T{i}", 1.0, i) for i in range(300)], "ticker string, last_price double, n int")
    pub.publish("risk_metrics", base)
    step = refresh.refresh_step(pub, base.schema)
    tick = "event_id bigint, ticker string, ts timestamp, price double, size bigint"
    start = datetime(2024, 1, 2)
    for n in range(3):
        before = files(tmp_path)
        step(spark.createDataFrame([(n, "T7", start + timedelta(minutes=n), 5.0 + n, 1)], tick), n)
        if n:
            assert len([f for f in files(tmp_path) - before if "/data/" in f]) == 1
    got = {r["ticker"]: r["last_price"] for r in pub.load_published("risk_metrics", base.schema).collect()}
    assert len(got) == 300 and got["T7"] == 7.0 and got["T8"] == 1.0
    pub.publish("risk_metrics", base)  # the next publication starts anew
    assert pub.load_published("risk_metrics", base.schema).where("ticker = 'T7'").first()["last_price"] == 1.0


def test_bars_step_reads_only_the_days_of_a_batch(spark, tmp_path):
    pub = Publisher(spark, str(tmp_path / "tables"))
    bronze = str(tmp_path / "bronze")
    step = refresh.bars_step(pub, bronze)
    tick = "event_id bigint, ticker string, ts timestamp, price double, size bigint"
    for n, d in enumerate((2, 3)):
        step(spark.createDataFrame([(n, "A", datetime(2024, 1, d, 10), 1.0 + n, 1)], tick), n)
    for f in files(tmp_path / "bronze/__day=2024-01-02"):
        with open(f, "wb") as broken:
            broken.write(b"no parquet")
    out = step(spark.createDataFrame([(9, "A", datetime(2024, 1, 3, 10, 1), 9.0, 1)], tick), 2)
    assert sorted((r["bar_start"].day, r["close"], r["volume"]) for r in out.collect()) == [(2, 1.0, 1), (3, 9.0, 2)]
