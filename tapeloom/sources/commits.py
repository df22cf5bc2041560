"""Small steps on the shared file system that make a commit safe with several writers."""

from __future__ import annotations

import os
import time

from pyspark.sql import SparkSession

#: seconds after which a claim that no manifest row followed is taken for a failed writer's
ABANDONED = 3600.0


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def claims(spark: SparkSession, path: str) -> dict[str, float]:
    """Names claimed below ``path`` and the age of each claim in seconds."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return {}
    now = time.time()
    return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in fs.listStatus(p)
            if not s.getPath().getName().startswith((".", "_"))}


def claim(spark: SparkSession, path: str, name: str) -> None:
    """Create the empty file ``path/name``; FileExistsError if anybody created it before.

    The file system decides between two callers: creation without overwriting
    is one step in HDFS and in object stores with conditional writes, and
    exclusive creation is one in a local file system.
    """
    fs, p = file_system(spark, f"{path}/{name}")
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        return
    try:
        fs.create(p, False).close()
    except Exception as error:
        if fs.exists(p):
            raise FileExistsError(f"{path}/{name} exists") from error
        raise
