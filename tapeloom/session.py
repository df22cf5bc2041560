"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a running session accepts. The skew settings matter most: a hot
# ticker or sector must be split when a join is shuffled.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # else the shuffle files of every staged table stay on disk until the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tapeloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
