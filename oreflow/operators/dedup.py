"""Keep one row per key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ITEM = re.compile(r"^(?P<column>.+?)(?:\s+(?P<way>ASC|DESC))?(?:\s+NULLS\s+(?P<nulls>FIRST|LAST))?$", re.IGNORECASE)


def order_columns(items: Sequence[str]) -> list[Column]:
    """``["op", "seq DESC", "ts DESC NULLS LAST"]`` as sort columns."""
    columns = []
    for item in items:
        parts = _ITEM.match(item.strip())
        column = F.col(parts["column"].strip())
        way = (parts["way"] or "ASC").lower()
        nulls = f"_nulls_{parts['nulls'].lower()}" if parts["nulls"] else ""
        columns.append(getattr(column, way + nulls)())
    return columns


def latest_by(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column], n: int = 1
) -> DataFrame:
    """The ``n``-th row of each key in the given order.

    The limit on the row number lets Spark cut every input partition to ``n`` rows per key before the
    shuffle, so a key that holds most of the rows costs no more than any other.
    """
    return _ranked(df, partition_by, order_by).where(F.col("_rank") == n).drop("_rank")


def best_by(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key: all that ``latest_by`` over these and any further rows can need."""
    return _ranked(df, partition_by, order_by).where(F.col("_rank") <= n).drop("_rank")


def _ranked(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    order = [c for item in order_by for c in (order_columns([item]) if isinstance(item, str) else [item])]
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order)))
