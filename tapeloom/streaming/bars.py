"""Live ticks with Structured Streaming. Every function also runs on a static
frame, which is how the streaming result is checked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WATERMARK = "10 minutes"


def stream_bars(ticks: DataFrame, width: str = "5 minutes", watermark: str = WATERMARK,
                key: str | None = "event_id") -> DataFrame:
    """OHLCV bars from ticks (ticker, ts, price, size). Repeated events within the
    watermark count once; events later than it are left to the backfill."""
    src = ticks.withWatermark("ts", watermark)
    if key:
        src = src.dropDuplicatesWithinWatermark([key]) if ticks.isStreaming else src.dropDuplicates([key])
    at = F.struct("ts", *([key] if key else []))
    return src.groupBy(F.window("ts", width).alias("w"), "ticker").agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", at).alias("close"), F.sum("size").alias("volume"),
    ).select(
        F.col("w.start").alias("bar_start"), F.col("w.end").alias("bar_end"), "ticker",
        "open", "high", "low", "close", "volume")


def stream_latest(ticks: DataFrame, key: str = "event_id") -> DataFrame:
    """Newest price per ticker; run in update or complete mode."""
    at = F.struct("ts", key)
    return ticks.groupBy("ticker").agg(
        F.max_by("price", at).alias("last_price"), F.max("ts").alias("last_ts"))


def stream_to_bronze(ticks: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append ticks to files partitioned by day."""
    writer = (
        ticks.withColumn("date", F.to_date("ts")).writeStream.format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("date").outputMode("append")
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def for_each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str,
                   every: str | None = None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
