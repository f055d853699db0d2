"""Registry of runnable queries: a Spark callable and, where SQL can say it, an oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of the driver tables under a name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


def portable(df: DataFrame) -> DataFrame:
    """Plain output types, so results compare across engines: text times, double decimals."""

    def shaped(field: T.StructField):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(kind, T.ArrayType):
            return F.array_join(column.cast("array<string>"), ",", "null").alias(field.name)
        if isinstance(kind, T.TimestampType):
            return column.cast("timestamp_ntz").cast("string").alias(field.name)
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[shaped(f) for f in df.schema.fields])


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(q.build(Tables(spark, sf_dir)))

    run.__name__ = q.name
    return run
