"""Tables written between layers.

A staged table cuts the lineage of everything downstream: it is written once
to the shared folder named by ``spark.checkpoint.dir`` and read back, so that
readers prune columns and push filters, and a lost executor costs one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: dict[tuple[str, str], DataFrame] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one inside the session's warehouse.

    Both are shared by the driver and all executors. Outside local mode the
    setting is required.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_once(spark: SparkSession, key: str, name: str, build) -> DataFrame:
    """``stage(build())``, once per application and key."""
    handle = (spark.sparkContext.applicationId, f"{name}|{key}")
    if handle not in _staged:
        _staged[handle] = stage(build(), name)
    return _staged[handle]
