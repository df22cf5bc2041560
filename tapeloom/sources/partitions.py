"""Tables under a stream: a manifest by partition, so that a batch rewrites and names only the parts it changes.

A commit writes the changed parts into a folder of its own and one manifest
entry with a row for each of them; the newest row of a part is its state. Every
``full_every`` commits an entry names all live parts, so that readers start
there, and what is older than the last ``keep`` versions is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.sources.commits import ABANDONED, claim, claims, exists, file_system, remove
from tapeloom.sources.staging import stage

ENTRY = "part string, folder string, rows bigint, since bigint"


def by_day(column: str, width: str = "yyyy-MM-dd") -> Column:
    """Parts of a table that grows by days (or months: ``yyyy-MM``); null days are a part of their own."""
    return F.coalesce(F.date_format(column, width), F.lit("none"))


def by_hash(column: str, parts: int = 64) -> Column:
    """Parts of a table whose size is its number of keys."""
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("string")


class PartitionedTable:
    """A table with unique ``keys`` in parts; ``part`` depends on the keys only and gives names that a path can hold.

    Readers see a commit when its manifest entry is there. Of two writers that
    started from one version the second is refused with FileExistsError and has
    to read again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str | None = None, keys: Sequence[str] = (), part: Column | None = None, *,
                 rows_per_file: int = 4_000_000, full_every: int = 50, keep: int = 10):
        self.spark, self.path, self.keys, self.part = spark, path.rstrip("/"), list(keys), part
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema  # None: a reader's, as the files have it
        self.rows_per_file, self.full_every, self.keep = rows_per_file, full_every, keep

    def versions(self) -> dict[int, bool]:
        """Committed versions, and whether each one's entry names all parts."""
        log = f"{self.path}/manifest"
        if not exists(self.spark, log):
            return {}
        fs, p = file_system(self.spark, log)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {int(n.split("-")[0]): n.endswith("-full") for n in names if n[:1].isdigit()}

    def _entry(self, version: int, full: bool) -> str:
        return f"{self.path}/manifest/{version:012d}-{'full' if full else 'part'}"

    def live(self, version: int | None = None) -> dict[str, tuple[str, int, int]]:
        """part -> (folder, rows, version that wrote it) at a version; a row per part, from the entries since the last full one."""
        log = self.versions()
        at = max(log, default=-1) if version is None else version
        if not log and version is None:
            return {}
        if at not in log:
            raise ValueError(f"version {at} not in {sorted(log)}")
        base = max((v for v, full in log.items() if full and v <= at), default=min(log))
        rows = self.spark.read.schema(ENTRY).parquet(
            *[self._entry(v, log[v]) for v in sorted(log) if base <= v <= at]).groupBy("part").agg(
            F.max_by(F.struct("folder", "rows", "since"), "since").alias("s")).select("part", "s.*").collect()
        return {r["part"]: (r["folder"], r["rows"], r["since"]) for r in rows}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read([f for f, _, _ in self.live(version).values()])

    def read_all(self) -> DataFrame:
        """The newest version with the columns of its files."""
        return self.spark.read.parquet(*[f for f, _, _ in self.live().values()])

    def parts(self, names: Sequence[str]) -> DataFrame:
        """The rows of some parts; no other part is listed or read."""
        live = self.live()
        return self._read([live[n][0] for n in names if n in live])

    def touched(self, delta: DataFrame) -> dict[str, int]:
        """The parts that rows of ``delta`` belong to, and their number in each."""
        return {r[0]: r[1] for r in delta.groupBy(self.part.alias("part")).count().collect()}

    def upsert(self, delta: DataFrame) -> list[str]:
        """Replace or add the rows of ``delta`` (unique keys) and return the parts that were written."""
        log = self.versions()
        version = self._next(log)
        delta = stage(delta.select(*self.schema.names), "upsert")  # a batch is read several times here
        names = self.touched(delta)
        if not names:
            return []
        live = self.live() if log else {}
        old = self._read([live[n][0] for n in names if n in live])
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"d.{k}")) for k in self.keys]
        kept = old.alias("o").join(delta.select(*self.keys).distinct().alias("d"), same, "left_anti")
        most = max(n + (live[p][1] if p in live else 0) for p, n in names.items())
        self._commit(version, log, live, kept.unionByName(delta), -(-most // self.rows_per_file))
        return sorted(names)

    def _next(self, log: dict[int, bool]) -> int:
        version = max(log, default=-1) + 1
        old = {n for n, age in claims(self.spark, f"{self.path}/claims").items() if age > ABANDONED}
        while f"{version:012d}" in old:
            version += 1
        return version

    def _commit(self, version: int, log: dict[int, bool], live: dict, new: DataFrame, spread: int) -> None:
        spark = self.spark
        target = f"{self.path}/data/{version:012d}-{uuid.uuid4().hex}"
        # a part that outgrows a file is dealt over several tasks
        laid = new.withColumn("__part", self.part).repartition("__part", F.pmod(F.xxhash64(*self.keys), F.lit(spread)))
        laid.write.option("maxRecordsPerFile", self.rows_per_file).partitionBy("__part").parquet(target)
        written = spark.read.schema(T.StructType([*self.schema.fields, T.StructField("__part", T.StringType())])).parquet(target)
        changed = {r["__part"]: (f"{target}/__part={r['__part']}", r["rows"], version)
                   for r in written.groupBy("__part").agg(F.count(F.lit(1)).alias("rows")).collect()}
        full = not log or version - max((v for v, f in log.items() if f), default=0) >= self.full_every
        named = {**live, **changed} if full else changed
        claim(spark, f"{self.path}/claims", f"{version:012d}")
        spark.createDataFrame([(p, *s) for p, s in named.items()], ENTRY).coalesce(1).write.parquet(self._entry(version, full))
        if full and log:
            self.expire()

    def expire(self) -> list[int]:
        """Remove what only versions before the last ``keep`` need; return the versions that can no longer be read.

        Kept versions start at the newest full entry that is old enough, so none of them loses an entry or a folder.
        """
        log = self.versions()
        oldest = sorted(log)[-self.keep:][0] if log else 0
        base = max((v for v, full in log.items() if full and v <= oldest), default=None)
        gone = [v for v in sorted(log) if base is not None and v < base]
        if not gone:
            return []
        used = {f.rsplit("/__part=", 1)[0] for f, _, _ in self.live(base).values()}
        for v in gone:
            remove(self.spark, self._entry(v, log[v]))
        fs, p = file_system(self.spark, f"{self.path}/data")
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if int(name.split("-")[0]) < base and not any(u.endswith(f"/{name}") for u in used):
                remove(self.spark, f"{self.path}/data/{name}")
        return gone
