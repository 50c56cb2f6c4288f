"""Row selection shared by the queries. Every filter is a plain predicate, so Spark pushes it to the scan."""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def _at(df: DataFrame, time: str, moment: datetime | str) -> Column:
    return F.lit(moment).cast(dict(df.dtypes)[time])


def in_time_range(df: DataFrame, start: datetime | str, stop: datetime | str, time: str = "ts") -> DataFrame:
    """Rows of [start, stop)."""
    return df.filter((F.col(time) >= _at(df, time, start)) & (F.col(time) < _at(df, time, stop)))


def default_range(
    now: datetime, start: datetime | None = None, stop: datetime | None = None
) -> tuple[datetime, datetime]:
    """The 24 hours before `stop`, which itself defaults to `now`."""
    stop = stop or now
    return start or stop - timedelta(hours=24), stop


def since_hours(df: DataFrame, now: datetime, hours: int = 24, time: str = "timestamp") -> DataFrame:
    """Rows not older than `hours` before `now`, the border included."""
    return df.filter(F.col(time) >= _at(df, time, now - timedelta(hours=hours)))


def any_of(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose column is one of `values`; no list or an empty one keeps every row."""
    return df.filter(F.col(column).isin(*values)) if values else df


def equals(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows that equal every given value; None and "" keep every row."""
    for column, value in wanted.items():
        if value:
            df = df.filter(F.col(column) == value)
    return df
