"""Date helpers. Landed dates are strings; a bad one becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COLLECTION_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def as_of_timestamp(as_of: str | None) -> Column:
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def as_of_date(as_of: str | None) -> Column:
    return F.lit(as_of).cast("timestamp").cast("date") if as_of else F.current_date()


def to_date_or_null(text: Column) -> Column:
    return text.try_cast("date")


def to_timestamp_or_null(text: Column) -> Column:
    return text.try_cast("timestamp")


def parse_collection_timestamp(text: Column) -> Column:
    # One to six digits after the point. Both marks are part of every match, and a failed parse
    # costs an exception.
    marked = F.contains(text, F.lit("T")) & F.contains(text, F.lit("."))
    return F.when(marked, F.try_to_timestamp(text, F.lit(COLLECTION_PATTERN)))


def month_start(text: Column) -> Column:
    return F.trunc(to_date_or_null(text), "month")


def year_month(text: Column) -> Column:
    return F.date_format(to_date_or_null(text), "yyyy-MM")


def interval(text: str) -> Column:
    """``interval("30 days")``, ``interval("12 months")``."""
    return F.expr(f"INTERVAL '{int(text.split()[0])}' {text.split()[1].rstrip('s').upper()}")
