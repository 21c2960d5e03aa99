"""Projections: select lists, added columns, trimming, classification."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.clock import AsOf, moment
from oreflow.functions.params import resolve


def select_where(df: DataFrame, select: Sequence[str] = (), where: Sequence[str] = ()) -> DataFrame:
    """Select expressions first, then every where clause, so that clauses may use computed columns.

    An expression may use the alias of an earlier one in the same list.
    """
    if select:
        df = df.selectExpr(*select)
    for clause in where:
        df = df.where(clause)
    return df


def add_metadata_columns(
    df: DataFrame,
    columns: Mapping[str, Any],
    trigger_time: dt.datetime | None = None,
    context: Mapping[str, Any] | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Add load columns. A value is ``"current_timestamp()"``, a ``"${...}"`` parameter, a Column or a literal."""
    added: dict[str, Column] = {}
    for name, value in columns.items():
        if isinstance(value, Column):
            added[name] = value
        elif value == "current_timestamp()":
            added[name] = moment(as_of)
        elif isinstance(value, str) and value.startswith("${") and value.endswith("}"):
            resolved = resolve(value, trigger_time or dt.datetime.now(), context)
            if isinstance(resolved, dt.datetime):
                added[name] = moment(resolved)
            else:
                added[name] = F.lit(resolved)
        else:
            added[name] = F.lit(value)
    return df.withColumns(added)


def rtrim_strings(df: DataFrame) -> DataFrame:
    """Cut trailing blanks of every string column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.rtrim(F.col(f"`{name}`")) for name in names}) if names else df


def classify(df: DataFrame, classes: Iterable[tuple[str, str]], otherwise: str, into: str) -> DataFrame:
    """Label each row with the first condition that holds."""
    label: Column | None = None
    for condition, name in classes:
        test = F.expr(condition)
        label = F.when(test, name) if label is None else label.when(test, name)
    return df.withColumn(into, F.lit(otherwise) if label is None else label.otherwise(otherwise))
