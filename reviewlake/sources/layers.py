"""Columnar layers: Bronze, Silver and Gold as partitioned files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas

PATHS = {
    "bronze": "bronze/google_maps_reviews",
    "silver": "silver/google_maps_reviews_enriched",
    "rollup": "rollup/google_maps_reviews",
    **{name: f"gold/{name}" for name in schemas.GOLD},
}
PARTITION_COLUMNS = {
    "bronze": ("partition_year", "partition_month", "partition_day", "bairro_pesquisado"),
    "silver": ("partition_year", "partition_month", "partition_day", "bairro"),
    "rollup": ("partition_year", "partition_month", "partition_day"),
}
#: What all layers kept by day are partitioned by first, so that a day is one folder.
DAY_COLUMNS = ("partition_year", "partition_month", "partition_day")
SCHEMAS = {"bronze": schemas.BRONZE, "silver": schemas.SILVER, "rollup": schemas.ROLLUP, **schemas.GOLD}


def layer_path(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/{PATHS.get(layer, layer)}"


def read_layer(spark: SparkSession, root: str, layer: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """Scan a layer. A known layer is read with its declared schema, so a
    partition column keeps its type even where folder names look numeric."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    elif layer in SCHEMAS and fmt != "delta":
        reader = reader.schema(SCHEMAS[layer])
    return reader.load(layer_path(root, layer))


def write_layer(df: DataFrame, root: str, layer: str, fmt: str = "parquet",
                mode: str = "overwrite", merge_schema: bool = False,
                dynamic: bool = False) -> str:
    """Write a layer with its partitioning and return the path.

    ``mode="overwrite"`` replaces the layer; with ``dynamic=True`` only the
    partitions present in ``df``, which makes re-running a day idempotent.
    ``merge_schema=True`` on an append accepts columns the layer lacks or has more of.
    """
    path = layer_path(root, layer)
    columns = PARTITION_COLUMNS.get(layer, ())
    if columns:
        # Few files per folder; a hot neighbourhood is split over several tasks.
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    writer = df.write.format(fmt).mode(mode)
    if columns:
        writer = writer.partitionBy(*columns)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    writer.save(path)
    return path


def day_parts(day: str) -> dict[str, int]:
    return dict(zip(DAY_COLUMNS, (int(part) for part in day[:10].split("-"))))


def read_day(spark: SparkSession, root: str, layer: str, day: str) -> DataFrame:
    """One day of a layer; only that day's folder is scanned."""
    rows = read_layer(spark, root, layer)
    for name, value in day_parts(day).items():
        rows = rows.filter(F.col(name) == value)
    return rows


def write_day(df: DataFrame, root: str, layer: str, day: str) -> str:
    """Replace one day of a layer (Parquet) by ``df``, whatever neighbourhoods it had or has; other days stay."""
    folder = "/".join([layer_path(root, layer), *(f"{k}={v}" for k, v in day_parts(day).items())])
    rest = [c for c in PARTITION_COLUMNS[layer] if c not in DAY_COLUMNS]
    df = df.drop(*DAY_COLUMNS)
    if rest:
        df = df.hint("rebalance", *[F.col(c) for c in rest])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*rest) if rest else writer).parquet(folder)
    return folder


def conform(df: DataFrame, other: DataFrame) -> DataFrame:
    """Append frames whose columns differ; a missing column reads as NULL."""
    return df.unionByName(other, allowMissingColumns=True)
