"""Time expressions driven by an explicit ``as_of`` instead of the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(value: datetime | str) -> datetime:
    """Accept a datetime or its ISO text."""
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def midnight(value: datetime | str) -> datetime:
    return datetime.combine(instant(value).date(), datetime.min.time())


def literal_like(df: DataFrame, column: str, value: datetime) -> Column:
    """A timestamp literal of the column's own type.

    Comparing a timestamp_ntz column with a timestamp literal would wrap the column in a cast,
    and the filter would no longer reach the Parquet scan.
    """
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[column].dataType)


def time_range(
    df: DataFrame,
    start: datetime,
    end: datetime,
    column: str = "event_timestamp",
    partition: str = "event_date",
    include_end: bool = False,
) -> DataFrame:
    """Rows with ``start <= column < end`` (or ``<= end``).

    The same range is put on the partition column where the table has one, so whole folders are
    skipped before any file is opened.
    """
    upper = literal_like(df, column, end)
    keep = (F.col(column) >= literal_like(df, column, start)) & (
        F.col(column) <= upper if include_end else F.col(column) < upper
    )
    if partition in df.columns:
        first, last = _days(start, end, include_end)
        keep = keep & F.col(partition).between(F.lit(first), F.lit(last))
    return df.filter(keep)


def _days(start: datetime, end: datetime, include_end: bool) -> tuple[date, date]:
    last = end if include_end else end - timedelta(microseconds=1)
    return start.date(), max(start.date(), last.date())


def hour_floor(column: str | Column) -> Column:
    return F.date_trunc("hour", F.col(column) if isinstance(column, str) else column)


def micros_between(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
