"""Batch steps for ``foreachBatch``. Each may be run again for the same batch id
without changing the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.operators.clean import refresh_prices
from tapeloom.operators.portfolios import strategy_parts
from tapeloom.sources.commits import exists
from tapeloom.sources.partitions import by_day, by_hash
from tapeloom.sources.sinks import Publisher
from tapeloom.sources.staging import stage
from tapeloom.streaming.bars import stream_bars, stream_latest


def layered(silver: Callable[[DataFrame, int], DataFrame], gold: Callable[[DataFrame, int], None]):
    """Silver, then gold on its result. An error in silver ends the batch, so gold
    never sees a half-made table and the batch is tried again."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        gold(silver(batch, batch_id), batch_id)

    return step


def refresh_step(publisher: Publisher, schema, name: str = "risk_metrics"):
    """Overwrite the published last prices with newer ones of the batch, each
    stamped with the time of its tick. Late ticks change nothing. Only the parts
    of the batch's tickers are read and written."""
    fields = T.StructType(list((schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields))
    if "updated_at" not in fields.names:
        fields = fields.add("updated_at", "timestamp")

    def step(batch: DataFrame, batch_id: int) -> None:
        table = publisher.live(name, fields, ["ticker"], by_hash("ticker"))
        latest = stage(stream_latest(batch), "latest")
        mine = table.parts(list(table.touched(latest))).join(latest.select("ticker"), "ticker", "left_semi")
        table.upsert(refresh_prices(mine, latest))

    return step


def upsert_step(publisher: Publisher, name: str, schema, keys, part: Column):
    """Put the rows of each batch into a live table; only the parts they belong to are rewritten.

    With a stream in update mode the batch holds the whole state of every key
    that changed, so a repeated batch changes nothing.
    """

    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        publisher.live(name, schema, keys, part).upsert(batch)
        return publisher.load_published(name, schema)

    return step


def pnl_step(publisher: Publisher, weights: DataFrame, name: str = "performance"):
    """P&L of days whose returns (ticker, date, daily_return) may come in several batches.

    The holdings' parts are kept by day, strategy and ticker, so a day sums what
    all batches brought and a repeated batch replaces its own parts. A batch
    rewrites the months of its days.
    """
    parts_schema = "date date, strategy string, ticker string, part double"
    schema = "date date, strategy string, daily_return double, holdings bigint"
    month = by_day("date", "yyyy-MM")

    def step(batch: DataFrame, batch_id: int) -> None:
        held = publisher.live(f"{name}_parts", parts_schema, ["date", "strategy", "ticker"], month)
        days = stage(batch.select("date").distinct(), "days")
        months = held.upsert(strategy_parts(weights, batch))
        day = held.parts(months).join(days, "date", "left_semi").groupBy(
            "date", "strategy").agg(F.sum("part").alias("daily_return"), F.count(F.lit(1)).alias("holdings"))
        publisher.live(name, schema, ["date", "strategy"], month).upsert(day)

    return step


BARS = ("bar_start timestamp, bar_end timestamp, ticker string, open double, high double, low double, "
        "close double, volume bigint")


def state_bars_step(publisher: Publisher, name: str = "silver"):
    """Bars of a stream of :func:`~tapeloom.streaming.bars.stream_bars` in update mode: the state has made them,
    so no tick is kept or read again."""
    return upsert_step(publisher, name, BARS, ["bar_start", "ticker"], by_day("bar_start"))


def bars_step(publisher: Publisher, bronze: str, name: str = "silver", width: str = "5 minutes"):
    """Keep the batch's ticks below ``bronze`` and make the bars they touch again from the ticks of their days.

    For ticks that come later than a watermark allows. Ticks lie by day and
    batch; a repeated batch replaces its own files, only days of the batch are
    listed and read, and an event that came twice counts once.
    """

    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        window = F.window("ts", width)
        batch.withColumns({"__day": by_day("ts"), "__batch": F.lit(batch_id)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("__day", "__batch").parquet(bronze)
        ends = [by_day("w.start"), by_day("w.end")]
        touched = stage(batch.select(window.alias("w"), "ticker").distinct(), "touched")
        days = [r[0] for r in touched.select(F.explode(F.array(*ends)).alias("d")).distinct().collect()]
        paths = [p for p in (f"{bronze}/__day={d}" for d in sorted(days)) if exists(spark, p)]
        if paths:
            ticks = spark.read.schema(batch.schema).option("basePath", bronze).parquet(*paths).select(*batch.columns)
            again = ticks.withColumn("w", window).join(touched, ["w", "ticker"], "left_semi").drop("w")
            publisher.live(name, BARS, ["bar_start", "ticker"], by_day("bar_start")).upsert(stream_bars(again, width))
        return publisher.load_published(name, BARS)

    return step
