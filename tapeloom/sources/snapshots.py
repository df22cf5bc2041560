"""Versioned tables: a folder of its own for every write, and a manifest row that names it.

A write that fails leaves a folder that no row names. A writer claims its
version by creating a file that must not exist, before it writes the row, so
the file system refuses the second of two writers that started from one version.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.sources.commits import ABANDONED, claim, claims, exists, remove

MANIFEST = (
    "version bigint, operation string, rows bigint, columns array<string>, written_at timestamp, folder string"
)


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/manifest"


def _claims(path: str) -> str:
    return f"{path.rstrip('/')}/claims"


def is_snapshot(spark: SparkSession, path: str) -> bool:
    return exists(spark, _manifest(path))


def snapshot_history(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """Manifest rows, newest first."""
    if not is_snapshot(spark, path):
        return spark.createDataFrame([], MANIFEST)
    log = spark.read.schema(MANIFEST).parquet(_manifest(path)).drop("of").orderBy(F.desc("version"))
    return log.limit(last) if last else log


def snapshot_info(spark: SparkSession, path: str) -> DataFrame:
    """One row: versions, newest version, its rows and columns, time of the last write."""
    return snapshot_history(spark, path).agg(
        F.count(F.lit(1)).alias("versions"), F.max("version").alias("current_version"),
        F.max_by("rows", "version").alias("rows"),
        F.max_by(F.size("columns"), "version").alias("columns"),
        F.max("written_at").alias("updated_at"))


def current_version(spark: SparkSession, path: str) -> int | None:
    return snapshot_history(spark, path).agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite", keep_history: bool = True,
                   partition_by: tuple[str, ...] = ()) -> int:
    """Write a version and return its number.

    ``append`` adds the rows as the next version. ``overwrite`` adds a full
    version; without ``keep_history`` it starts again at version 0, which is for
    a table with one writer. Rows are counted from the footers of the written
    files. FileExistsError if another writer took the version meanwhile; its
    version stands, and the folder of the refused one is removed.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    spark = df.sparkSession
    newest = current_version(spark, path) if is_snapshot(spark, path) else None
    fresh = mode == "overwrite" and not keep_history
    version = 0 if newest is None or fresh else newest + 1
    ages = claims(spark, _claims(path))
    start = max((int(n.split("-")[0]) for n in ages), default=0) + (1 if fresh else 0)  # counts the restarts
    while not fresh and f"{start}-{version}" in ages and ages[f"{start}-{version}"] > ABANDONED:
        version += 1
    target = f"{_data(path)}/{version}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    row = written.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(version).cast("long").alias("version"), F.lit(mode).alias("operation"), "rows",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.current_timestamp().alias("written_at"), F.lit(target).alias("folder")).coalesce(1)
    try:
        claim(spark, _claims(path), f"{start}-{version}")
    except FileExistsError:
        remove(spark, target)
        raise
    if fresh:
        row.withColumn("of", F.lit(version)).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("of").parquet(_manifest(path))
    else:
        row.write.mode("errorifexists").parquet(f"{_manifest(path)}/of={version}")
    return version


def read_snapshot(spark: SparkSession, path: str, version: int | None = None,
                  read: str = "latest") -> DataFrame:
    """The newest or a given version; ``read='all'`` unites the newest full version
    with the versions appended to it (up to ``version``)."""
    if not is_snapshot(spark, path):
        raise FileNotFoundError(f"no snapshot table at {path}")
    log = {r["version"]: r for r in snapshot_history(spark, path).select(
        "version", "operation", "folder").collect()}  # one row per write
    at = max(log) if version is None else version
    if at not in log:
        raise ValueError(f"version {at} not in {sorted(log)}")
    base = at
    if read != "latest":
        base = max((v for v, r in log.items() if r["operation"] == "overwrite" and v <= at), default=min(log))
    folders = [log[v]["folder"] for v in sorted(log) if base <= v <= at]
    parts = [spark.read.parquet(f) for f in folders]  # each may have partitions of its own
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def expire_snapshots(spark: SparkSession, path: str, keep: int = 10) -> list[int]:
    """Remove the versions that neither the newest ``keep`` nor the full version they build on need; return their numbers."""
    log = {r["version"]: r for r in snapshot_history(spark, path).select("version", "operation", "folder").collect()}
    kept = sorted(log)[-keep:]
    base = max((v for v, r in log.items() if r["operation"] == "overwrite" and kept and v <= kept[0]), default=None)
    gone = [v for v in sorted(log) if base is not None and v < base]
    for v in gone:  # the row first, so that no row names a folder that is gone
        remove(spark, f"{_manifest(path)}/of={v}")
        remove(spark, log[v]["folder"])
    return gone


def to_snapshot(spark: SparkSession, path_in: str, path_out: str) -> int:
    return write_snapshot(spark.read.parquet(path_in), path_out)
