"""How a query and its SQL twin are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.plans import fixtures


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    survey: str
    doubles: tuple[str, ...]
    digits: int


REGISTRY: dict[str, Query] = {}
VIEWS: dict[str, str] = {}


def query(name: str, survey: str, sql: str | None = None, doubles: str = "", digits: int = 6):
    """Register a Spark query with its SQL; ``doubles`` names the columns rounded on both sides."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, sql, survey, tuple(doubles.split()), digits)
        return fn

    return register


def view(name: str, sql: str) -> None:
    """A named SQL table the twins may refer to."""
    VIEWS[name] = sql


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = REGISTRY[name]

    def run(spark, sf_dir):
        fixtures.tune(spark)
        return rounded(q.run(spark, str(sf_dir).rstrip("/")), q.digits)

    run.__name__ = name
    return run


def twin_sql(name: str) -> str | None:
    q = REGISTRY[name]
    if q.sql is None:
        return None
    sql = q.sql.strip()
    if q.doubles:
        fixed = ", ".join(
            f"round(CAST({c} AS DOUBLE), {q.digits}) + 0.0::DOUBLE AS {c}" for c in q.doubles
        )
        sql = f"SELECT * REPLACE ({fixed}) FROM ({sql})"
    return fixtures.with_tables(sql, VIEWS)
