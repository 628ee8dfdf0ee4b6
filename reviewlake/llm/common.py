"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import scratch_path


BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a fixed table that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def body(text: str) -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(named(text).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that few results are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_batches(df: DataFrame) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch to ``BATCH_BYTES``.

    A batch of texts is held several times over, by the executor and by its Python workers.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    wanted = f"{BATCH_BYTES}b"
    if df.sparkSession.conf.get(key) != wanted:
        df.sparkSession.conf.set(key, wanted)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sql_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
