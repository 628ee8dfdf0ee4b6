"""External tables over the layers, so that plain SQL can query them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlake import schemas
from reviewlake.sources.layers import layer_path

TABLES = {
    "bronze": "bronze_google_maps_reviews",
    "silver": "silver_google_maps_reviews_enriched",
    **{name: name for name in schemas.GOLD},
}


def register_table(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet",
                   replace: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{name}` USING {fmt} LOCATION '{path}'")
    if fmt != "delta" and _partitioned(spark, db, name):
        spark.sql(f"MSCK REPAIR TABLE `{db}`.`{name}`")


def _partitioned(spark: SparkSession, db: str, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(f"`{db}`.`{name}`"))


def register_all(spark: SparkSession, root: str, db: str = "datalake", fmt: str = "parquet") -> None:
    """Register every layer that is not registered yet."""
    for layer, table in TABLES.items():
        register_table(spark, db, table, layer_path(root, layer), fmt, replace=False)


def list_tables(spark: SparkSession, db: str = "datalake") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{db}`").select("namespace", "tableName", "isTemporary")


def drop_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def run_sql(spark: SparkSession, text: str, args=None) -> DataFrame:
    """A parameterised query: named (``:x``) or positional (``?``) values, never spliced text."""
    return spark.sql(text, args=args) if args else spark.sql(text)
