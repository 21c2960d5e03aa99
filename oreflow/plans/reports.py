"""Dashboard queries over the run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf, moment_like
from oreflow.plans.history import until
from oreflow.plans.monitor import Thresholds, stage_limit


def _success() -> Column:
    return F.count_if(F.col("status") == "success")


def run_status(history: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Runs of the last days per dataflow and stage."""
    dtype = history.select("start_time").schema[0].dataType.simpleString()
    first = F.date_sub(moment_like(history, "start_time", as_of).cast("date"), days).cast(dtype)
    return until(history, as_of).where(F.col("start_time") >= first).groupBy("dataflow_id", "stage").agg(
        F.count(F.lit(1)).alias("total_runs"), _success().alias("success_count"),
        F.avg("duration_seconds").alias("avg_duration"), F.max("start_time").alias("last_run"),
    )


def recent_runs(history: DataFrame, n: int = 10, as_of: AsOf = None) -> DataFrame:
    """The newest runs."""
    return until(history, as_of).orderBy(F.col("start_time").desc(), F.col("execution_id").desc()).limit(n).select(
        "execution_id", "dataflow_id", "stage", "status", "start_time", "duration_seconds", "rows_processed"
    )


def weekly_review(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Mean run time, rows and error rate per week and stage."""
    errors = F.count_if(F.col("status") == "failed") * F.lit(100.0) / F.count(F.lit(1))
    return until(history, as_of).groupBy(F.date_trunc("week", "start_time").cast("date").alias("week"), "stage").agg(
        F.count(F.lit(1)).alias("runs"), F.avg("duration_seconds").alias("avg_duration"),
        F.sum("rows_processed").alias("rows_processed"), F.round(errors, 2).alias("error_rate_pct"),
    )


def sla_attainment(history: DataFrame, t: Thresholds = Thresholds(), as_of: AsOf = None) -> DataFrame:
    """Share of successful runs within the limit, per month and stage that has a limit."""
    limited = until(history, as_of).withColumn("_limit", stage_limit(t)).where(
        (F.col("status") == "success") & F.col("_limit").isNotNull()
    )
    met = F.count_if(F.col("duration_seconds") <= F.col("_limit"))
    return limited.groupBy(F.date_trunc("month", "start_time").cast("date").alias("month"), "stage").agg(
        F.count(F.lit(1)).alias("runs"), met.alias("within_limit"),
        F.round(met * F.lit(100.0) / F.count(F.lit(1)), 2).alias("attainment_pct"),
    )
