"""Row filters of the change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.clock import AsOf, moment


def ingested_on(df: DataFrame, column: str, as_of: AsOf = None, days: int = 1) -> DataFrame:
    """Rows loaded within the ``days`` calendar days that end with the day of ``as_of``.

    Timestamps are compared with a half-open range instead of being cut to dates, so the filter prunes
    partitions and reaches the file scan. Text is read as an ISO timestamp.
    """
    dtype = df.select(column).schema[0].dataType
    day = moment(as_of).cast("date")
    first = F.date_sub(day, days - 1)
    value = F.col(column)
    if isinstance(dtype, T.DateType):
        return df.where((value >= first) & (value <= day))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        name = dtype.simpleString()
        return df.where((value >= first.cast(name)) & (value < F.date_add(day, 1).cast(name)))
    as_date = F.try_to_timestamp(value).cast("date")
    return df.where((as_date >= first) & (as_date <= day))


def valid_change(operation: str, key: str) -> Column:
    """Inserts and updates carry the key of the joined master row; deletes, having none, do not."""
    op, has_key = F.col(operation), F.col(key).isNotNull()
    return (op.isin("I", "U") & has_key) | ((op == "D") & ~has_key)


def since(df: DataFrame, column: str, cursor: AsOf) -> DataFrame:
    """Rows at or after the cursor; the comparison is pushed into the source."""
    dtype = df.select(column).schema[0].dataType.simpleString()
    return df.where(F.col(column) >= moment(cursor, dtype))
