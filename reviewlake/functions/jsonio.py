"""JSON messages and JSON paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import schemas


def parse_message(text: Column, schema=schemas.QUEUE_MESSAGE) -> Column:
    """A queue message as a struct; malformed JSON yields NULL fields."""
    return F.from_json(text, schema)


def to_message(df: DataFrame) -> DataFrame:
    """One JSON ``value`` per row, the shape a message topic takes."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def json_extract(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)
