"""Table checks and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf, moment
from oreflow.functions.text import thousands


@dataclass(frozen=True)
class TableChecks:
    """What one table must satisfy. ``frame`` is None when the table does not exist.

    ``measured`` has the counts of ``measure`` for the table, if they are known already (see ``touched_measure``); the
    table is not read then.
    """

    frame: DataFrame | None
    min_rows: int | None = 1
    required: Sequence[str] = ()
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    measured: DataFrame | None = None


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names among the columns of ``df``; column names are compared without case."""
    have = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in have]


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows per listed column, in one pass; columns that do not exist are skipped."""
    present = _present(df, columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(present)]
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_count")) for i, c in enumerate(present)]
    )
    return counts.select(F.inline(entries.cast("array<struct<column_name:string,null_count:bigint>>")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def measure(checks: TableChecks) -> DataFrame:
    """All counts a table needs in one row and one scan.

    With a uniqueness check the scan is grouped by the key first; row and null counts ride along as partial
    sums, so a heavy key is reduced before the shuffle.
    """
    df = checks.frame
    nullable = _present(df, checks.not_null)
    rows = F.count(F.lit(1)).alias("_rows")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(nullable)]
    keyed = checks.unique and len(_present(df, checks.unique)) == len(checks.unique)
    if not keyed:
        return df.agg(rows, *nulls).withColumn("_duplicates", F.lit(None).cast("long"))
    groups = df.groupBy(*checks.unique).agg(rows, *nulls)
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(nullable))],
        F.count_if(F.col("_rows") > 1).alias("_duplicates"),
    )


def touched_measure(before: DataFrame, batch: DataFrame, checks: TableChecks) -> DataFrame:
    """What appending ``batch`` to the table ``before`` adds to the counts of ``measure``: one row of differences.

    Only keys of the batch can become, or be anything but what they were. So of the table the key columns are read, cut to
    those keys (null being a key like others), and grouped with the batch: a busy key is a row per task on both sides.
    Sums of these rows from the first batch on are the counts of the whole table; ``added_measures`` adds them.
    """
    keys, nullable = list(checks.unique), _present(batch, checks.not_null)
    if not keys or len(_present(batch, keys)) < len(keys):
        raise ValueError("the keys of the batch are needed")
    columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    new = batch.select(*columns, *[F.col(c).isNull().alias(f"_is_null_{i}") for i, c in enumerate(nullable)])
    new = new.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_new"), *[F.count_if(f"_is_null_{i}").alias(f"_null_{i}") for i in range(len(nullable))])
    given = new.select(*[F.col(n).alias(f"_g{n}") for n in names])
    same = [F.col(n).eqNullSafe(F.col(f"_g{n}")) for n in names]
    old = before.select(*columns).join(given, same, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("_old"))
    old = old.select("_old", *[F.col(n).alias(f"_o{n}") for n in names])
    both = new.join(old, [F.col(n).eqNullSafe(F.col(f"_o{n}")) for n in names], "left")
    held = F.coalesce(F.col("_old"), F.lit(0))
    return both.agg(
        F.coalesce(F.sum("_new"), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(nullable))],
        (F.count_if(held + F.col("_new") > 1) - F.count_if(held > 1)).alias("_duplicates"),
    )


def added_measures(measures: Sequence[DataFrame]) -> DataFrame:
    """The counts of a table from those of its batches."""
    whole = measures[0]
    for more in measures[1:]:
        whole = whole.unionByName(more)
    return whole.agg(*[F.sum(c).alias(c) for c in whole.columns])


def _entry(check: str, passed: Column, ok: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.when(passed, "PASSED").otherwise("FAILED").alias("status"),
        F.when(passed, ok).otherwise(bad).alias("message"),
    )


def _listing(names: Sequence[str]) -> str:
    return ", ".join(names)


def check_table(spark: SparkSession, name: str, checks: TableChecks) -> DataFrame:
    """Rows (table, check, status, message) for one table."""
    exists = F.lit(checks.frame is not None)
    entries = [_entry("table_exists", exists, F.lit("table exists"), F.lit("table does not exist"))]
    if checks.frame is None:
        source = spark.range(1)
    else:
        df, source = checks.frame, measure(checks) if checks.measured is None else checks.measured
        if checks.min_rows is not None:
            rows = F.col("_rows")
            entries.append(_entry(
                "record_count", rows >= checks.min_rows,
                F.concat(F.lit("record count: "), thousands(rows)),
                F.concat(F.lit("too few records: "), rows.cast("string"), F.lit(f" < {checks.min_rows}")),
            ))
        if checks.required:
            missing = missing_columns(df, checks.required)
            entries.append(_entry(
                "metadata_columns", F.lit(not missing),
                F.lit(f"all required columns exist: {_listing(checks.required)}"),
                F.lit(f"missing columns: {_listing(missing)}"),
            ))
        if checks.not_null:
            nullable = _present(df, checks.not_null)
            bad = F.lit(False)
            for i in range(len(nullable)):
                bad = bad | (F.col(f"_null_{i}") > 0)
            found = F.array_join(F.array_compact(F.array(*[
                F.when(F.col(f"_null_{i}") > 0, F.concat(F.lit(f"{c}="), F.col(f"_null_{i}").cast("string")))
                for i, c in enumerate(nullable)
            ])), ", ") if nullable else F.lit("")
            entries.append(_entry(
                "null_values", ~bad,
                F.lit(f"no nulls in: {_listing(checks.not_null)}"), F.concat(F.lit("nulls found: "), found),
            ))
        if checks.unique:
            duplicates = F.col("_duplicates")
            skipped = len(_present(df, checks.unique)) < len(checks.unique)
            good = "key columns not found, check skipped" if skipped else f"no duplicates on: {_listing(checks.unique)}"
            entries.append(_entry(
                "duplicates", F.coalesce(duplicates, F.lit(0)) == 0, F.lit(good),
                F.concat(F.lit("duplicate keys: "), duplicates.cast("string")),
            ))
    return source.select(F.lit(name).alias("table"), F.inline(F.array(*entries)))


def validate(spark: SparkSession, plan: Mapping[str, TableChecks]) -> DataFrame:
    """All checks of all tables. Checks beyond existence are made only for tables that exist."""
    result = None
    for name, checks in plan.items():
        rows = check_table(spark, name, checks)
        result = rows if result is None else result.unionByName(rows)
    return result


def validation_report(results: DataFrame, dataflow_id: str, as_of: AsOf = None) -> DataFrame:
    """One row with totals, overall status and the whole report as JSON; as long as the plan, not the data."""
    entry = F.struct("table", "check", "status", "message")
    totals = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASSED").alias("passed_checks"),
        F.count_if(F.col("status") == "FAILED").alias("failed_checks"),
        F.array_sort(F.collect_list(entry)).alias("validations"),
    )
    report = totals.select(
        F.lit(dataflow_id).alias("dataflow_id"),
        moment(as_of, "timestamp_ntz").alias("timestamp"),
        F.when(F.col("failed_checks") == 0, "PASSED").otherwise("FAILED").alias("overall_status"),
        "total_checks", "passed_checks", "failed_checks", "validations",
    )
    return report.withColumn("report_json", F.to_json(F.struct(*report.columns))).drop("validations")
