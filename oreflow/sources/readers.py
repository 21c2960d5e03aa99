"""Tables, files, streams and JDBC sources as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_source(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    stream: bool = False,
) -> DataFrame:
    """A path (when it holds a slash) or a table name, in batch or as a stream."""
    reader = (spark.readStream if stream else spark.read).options(**(options or {}))
    if "/" not in location:
        return reader.table(location)
    reader = reader.format(fmt)
    if schema is None and stream:
        schema = spark.read.format(fmt).options(**(options or {})).load(location).schema
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


def open_table(
    spark: SparkSession, location: str, fmt: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame | None:
    """The table, or None when there is none at that name or path."""
    if "/" not in location:
        return spark.table(location) if spark.catalog.tableExists(location) else None
    reader = spark.read.format(fmt).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(location)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def rows_like(spark: SparkSession, rows: Sequence[Any], table: DataFrame) -> DataFrame:
    """Local rows typed by the schema of an existing table."""
    return spark.createDataFrame(rows, table.schema)


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetchsize: int = 1000,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    num_partitions: int = 8,
    prepare_query: str | None = None,
    db_type: str | None = None,
) -> dict[str, str]:
    """Reader options. A query becomes a ``dbtable`` subquery, the only form that can be read in parallel.

    ``prepare_query`` runs on the same connection just before the read; on ``mssql`` it reads uncommitted rows.
    """
    if bool(query) == bool(table):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetchsize)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if prepare_query:
        if (db_type or "").lower() == "mssql":
            prepare_query = f"SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED; {prepare_query}"
        options["prepareQuery"] = prepare_query
    options["dbtable"] = table or f"({query.strip().rstrip(';')}) source_rows"
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its bounds; see jdbc_bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return options


def jdbc_bounds(spark: SparkSession, column: str, **source: Any) -> tuple[Any, Any]:
    """Smallest and largest value of the partition column; the database computes both."""
    base = source.get("table") or f"({source['query'].strip().rstrip(';')}) bounded"
    request = {**source, "table": None, "query": f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {base}"}
    row = spark.read.format("jdbc").options(**jdbc_options(**request)).load().first()
    return row[0], row[1]


def read_jdbc(
    spark: SparkSession,
    partition_column: str | None = None,
    num_partitions: int = 8,
    predicates: Sequence[str] | None = None,
    **source: Any,
) -> DataFrame:
    """JDBC scan. With a partition column it runs as ``num_partitions`` range scans over its bounds.

    Range scans are uneven when the values are; ``predicates``, one per task and together covering every row
    once, replace them then. Filters and column selection on the result are pushed into the database.
    """
    if predicates:
        options = jdbc_options(**source)
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    bounds = jdbc_bounds(spark, partition_column, **source) if partition_column else None
    if bounds and bounds[0] is None:
        partition_column, bounds = None, None
    options = jdbc_options(
        **source, partition_column=partition_column, bounds=bounds, num_partitions=num_partitions
    )
    return spark.read.format("jdbc").options(**options).load()
