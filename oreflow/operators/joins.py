"""Joins between feed, master and allow-list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_master(log: DataFrame, master: DataFrame, log_key: str, master_key: str) -> DataFrame:
    """Change log left-joined to the master rows.

    Every log row stays; rows whose master row is gone carry nulls. The master must be unique on its key.
    A key that dominates the log is split by adaptive skew handling, which may split the left side here.
    Where both sides have the key under one name, the log's is renamed to ``S_<name>``, as the master's is null for
    deletes; other columns that both have are refused, because one of them would be lost.
    """
    have = {c.lower() for c in master.columns}
    if log_key.lower() == master_key.lower():
        renamed = f"S_{log_key}"
        if renamed.lower() in {c.lower() for c in [*log.columns, *master.columns]}:
            raise ValueError(f"the key {log_key!r} of the log cannot be renamed to {renamed!r}: there is such a column")
        log, log_key = log.withColumnRenamed(log_key, renamed), renamed
    clash = [c for c in log.columns if c.lower() in have]
    if clash:
        raise ValueError(f"log and master both have {', '.join(clash)}; select or rename before the join")
    return log.join(master, log[log_key] == master[master_key], "left")


def semi_join_allowlist(
    df: DataFrame,
    allow: DataFrame,
    column: str,
    value_column: str,
    type_column: str | None = None,
    type_value: str | None = None,
    use_column: str | None = None,
    use_value: str = "Y",
) -> DataFrame:
    """Rows whose ``column`` is listed and in use.

    List values that do not fit the type of the column match nothing.
    The list may grow with the data, so no broadcast is forced: adaptive execution broadcasts it when its
    measured size allows and otherwise shuffles both sides.
    """
    if use_column:
        allow = allow.where(F.upper(F.col(use_column)) == use_value.upper())
    if type_column and type_value is not None:
        allow = allow.where(F.col(type_column) == type_value)
    dtype = df.select(column).schema[0].dataType
    listed = allow.select(F.col(value_column).try_cast(dtype).alias("_listed"))
    return df.join(listed, df[column] == listed["_listed"], "left_semi")


def conform(df: DataFrame, contract: str | T.StructType) -> DataFrame:
    """Rows in the columns of a contract (DDL text or a type): columns of another type are cast, missing ones are null.

    Columns that the contract lacks and types that cannot be cast are refused before anything is read; a value that does
    not fit its type stops the query that reads it.
    """
    fields = (T.StructType.fromDDL(contract) if isinstance(contract, str) else contract).fields
    held = {c.lower(): c for c in df.columns}
    unknown = sorted(set(held) - {f.name.lower() for f in fields})
    if unknown:
        raise ValueError(f"columns outside the contract: {', '.join(unknown)}")
    return df.select(*[
        (F.col(f"`{held[f.name.lower()]}`") if f.name.lower() in held else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ])


def append_flows(sources: Sequence[DataFrame]) -> DataFrame:
    """Several sources into one target; columns that a source lacks are null."""
    result = sources[0]
    for other in sources[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
