"""Clock values are arguments everywhere; none of the operators reads the system time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_datetime(value: datetime | date | str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def timestamp(value: datetime | date | str) -> Column:
    """A literal without time zone, so that results do not depend on the session's zone."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")
