"""Writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.sources.commits import exists
from tapeloom.sources.partitions import PartitionedTable
from tapeloom.sources.snapshots import current_version, is_snapshot, read_snapshot, write_snapshot


def write_by_date(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 4_000_000) -> None:
    """Partition by ``date``. Overwriting replaces only the dates present in ``df``.

    The rows of each date are counted first: a date of more than
    ``rows_per_file`` rows is dealt over as many tasks as it needs by the hash
    of its rows, all others stay one file.
    """
    counts = df.groupBy("date").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("__files"))
    part = F.pmod(F.xxhash64(*df.columns), F.coalesce("__files", F.lit(1)))
    laid = (
        df.join(F.broadcast(counts), "date", "left")  # one row a day
        .select(*df.columns, part.alias("__file")).repartition("date", "__file")
        .sortWithinPartitions("date", "ticker").drop("__file")
    )
    writer = laid.write.partitionBy("date").mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_bars(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_csv_by(df: DataFrame, path: str, key: str = "indicator_id") -> None:
    """One set of CSV files per key."""
    df.write.mode("overwrite").option("header", True).partitionBy(key).csv(path)


def export_json_preview(df: DataFrame, path: str, order: Sequence[str], n: int = 50) -> None:
    df.orderBy(*order).limit(n).coalesce(1).write.mode("overwrite").json(path)


def upsert_by_key(df: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``delta``, plus ``delta``."""
    kept = df.join(delta.select(*keys).distinct(), list(keys), "left_anti").select(*df.columns)
    return kept.unionByName(delta, allowMissingColumns=True)


class Publisher:
    """Serving tables under one folder. Each publication is a new snapshot, so
    readers see the old table until the manifest row of the new one is written.

    A stream changes a published table through :meth:`live`, a table in parts
    that belongs to one publication; the next publication replaces it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def publish(self, name: str, df: DataFrame, batch_date=None) -> int:
        version = write_snapshot(df, self.path(name))
        day = F.coalesce(F.lit(batch_date).cast("date"), F.current_date())
        self.spark.range(1).select(
            F.lit(name).alias("name"), day.alias("batch_date"), F.current_timestamp().alias("updated_at"),
        ).write.mode("append").parquet(f"{self.root}/_published")
        return version

    def _live_path(self, name: str) -> str:
        path = self.path(name)
        version = current_version(self.spark, path) if is_snapshot(self.spark, path) else None
        return f"{path}.live/{'none' if version is None else version}"

    def live(self, name: str, schema: T.StructType | str, keys: Sequence[str], part: Column, **more) -> PartitionedTable:
        """The newest publication as a table in parts; it is filled when it is first asked for.

        Columns of ``schema`` that the publication lacks are null.
        """
        table = PartitionedTable(self.spark, self._live_path(name), schema, keys, part, **more)
        if not table.versions() and is_snapshot(self.spark, self.path(name)):
            base = read_snapshot(self.spark, self.path(name))
            have = {f.name for f in base.schema}
            table.upsert(base.select(*[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]))
        return table

    def load_published(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The newest publication with what streams changed since, or an empty table of the schema."""
        live = PartitionedTable(self.spark, self._live_path(name))
        if live.versions():
            return live.read_all()
        if not exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], schema)
        return read_snapshot(self.spark, self.path(name))

    def manifest(self) -> DataFrame:
        """(name, batch_date, updated_at) of every publication."""
        if not exists(self.spark, f"{self.root}/_published"):
            return self.spark.createDataFrame(
                [], "name string, batch_date date, updated_at timestamp")
        return self.spark.read.parquet(f"{self.root}/_published")


def freshness(manifest: DataFrame, now, max_age_days: int = 1) -> DataFrame:
    """One row: newest batch date, its age, whether it is valid, and how recent
    the last update is: under 30 minutes, under 2 hours, or older."""
    now = F.lit(now).cast("timestamp")
    age = F.datediff(now.cast("date"), F.max("batch_date"))
    seconds = F.unix_timestamp(now) - F.unix_timestamp(F.max("updated_at").cast("timestamp"))
    return manifest.agg(
        F.max("batch_date").alias("last_batch"),
        age.cast("long").alias("age_days"),
        F.coalesce(age <= max_age_days, F.lit(False)).alias("is_valid"),
        F.when(seconds < 1800, "fresh").when(seconds < 7200, "recent").otherwise("stale").alias("status"))
