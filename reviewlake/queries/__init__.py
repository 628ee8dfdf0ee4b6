"""Registered queries: each a Spark plan over the given tables, most with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def rows_total():
    return F.count(F.lit(1)).alias("total")


def portable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and string arrays as text, so that engines print them alike."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(build(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def load_all() -> None:
    from reviewlake.queries import (  # noqa: F401
        bronze, control, dashboards, gold, quality, streams, texts,
    )
