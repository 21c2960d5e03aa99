"""One notion of "now" for every time-relative operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.datetime | str | Column | None


def moment(as_of: AsOf = None, dtype: str = "timestamp") -> Column:
    """``as_of`` as a column of type ``dtype``; the current time when it is None.

    Text and datetimes become literals that the optimizer folds, so comparisons against them still reach
    the file scan.
    """
    if as_of is None:
        return F.current_timestamp().cast(dtype)
    if isinstance(as_of, Column):
        return as_of.cast(dtype)
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast(dtype)


def moment_like(df: DataFrame, column: str, as_of: AsOf = None) -> Column:
    """``as_of`` in the timestamp type of ``df[column]``, so that neither side needs a per-row cast."""
    return moment(as_of, df.select(column).schema[0].dataType.simpleString())
