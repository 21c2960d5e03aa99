"""Checks over the run history: failures, row-count anomalies, stage limits, success rates, staleness."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf, moment_like
from oreflow.operators.dedup import latest_by
from oreflow.plans.history import RUN_DATE, until

# Seconds a successful run of each stage may take.
STAGE_LIMITS = {"rdb_ingestion": 900.0, "bronze": 600.0, "silver": 900.0}


@dataclass(frozen=True)
class Thresholds:
    window_hours: int = 1
    history_days: int = 30
    z: float = 3.0
    z_critical: float = 5.0
    min_samples: int = 5
    exclude_latest: bool = False
    limits: Mapping[str, float] = field(default_factory=lambda: dict(STAGE_LIMITS))
    rate_hours: int = 24
    rate: float = 80.0
    rate_critical: float = 50.0
    min_runs: int = 3
    stale_hours: int = 2
    stale_critical: int = 6
    error_length: int = 200


def _hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def _within(history: DataFrame, first: Column, as_of: AsOf) -> DataFrame:
    """Runs that started from ``first`` on; a given ``as_of`` also hides runs that started after it."""
    runs = history.where(F.col("start_time") >= first)
    if RUN_DATE in history.columns:  # stored by day, so only the days of the window are listed and opened
        runs = runs.where(F.col(RUN_DATE) >= first.cast("date"))
    return until(runs, as_of)


def _recent(history: DataFrame, as_of: AsOf, hours: int) -> DataFrame:
    return _within(history, moment_like(history, "start_time", as_of) - _hours(hours), as_of)


def recent_failures(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    """Failed runs inside the window."""
    return _recent(history, as_of, t.window_hours).where(F.col("status") == "failed").select(
        "execution_id", "dataflow_id", "stage", "error_message", "start_time", "duration_seconds"
    )


def row_anomalies(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    """Latest run of the window against the mean of the history, in standard deviations.

    The baseline is a partially aggregated group; the latest run comes from a scan limited to the window. Both
    sides of the join have one row per dataflow and stage. By default the run under test is part of its own
    baseline, which bounds the score by (n - 1) / sqrt(n); ``exclude_latest`` leaves it out.
    """
    keys = ["dataflow_id", "stage"]
    dtype = history.select("start_time").schema[0].dataType.simpleString()
    now = moment_like(history, "start_time", as_of)
    counted = history.where((F.col("status") == "success") & F.col("rows_processed").isNotNull())
    latest = latest_by(
        _recent(counted, as_of, t.window_hours), keys, ["start_time DESC", "execution_id DESC"]
    ).select(*keys, "execution_id", F.col("rows_processed").alias("latest_rows"),
             F.col("start_time").alias("latest_run_time"))
    first_day = F.date_sub(now.cast("date"), t.history_days).cast(dtype)
    baseline = _within(counted, first_day, as_of)
    if t.exclude_latest:
        tested = latest.select(F.col("execution_id").alias("_tested"))
        baseline = baseline.join(tested, F.col("execution_id") == F.col("_tested"), "left_anti")
    stats = baseline.groupBy(*keys).agg(
        F.avg("rows_processed").alias("_mean"),
        F.stddev_samp("rows_processed").alias("_spread"),
        F.count(F.lit(1)).alias("sample_count"),
    ).where(F.col("sample_count") >= t.min_samples)
    score = (F.col("latest_rows") - F.col("_mean")) / F.col("_spread")
    return (
        latest.join(stats, keys)
        .where(F.col("_spread") > 0)
        .withColumn("_score", score)
        .where(F.abs("_score") > t.z)
        .select(
            *keys, "latest_rows",
            F.round("_mean", 2).alias("historical_avg"),
            F.round("_spread", 2).alias("historical_stddev"),
            "latest_run_time",
            F.round("_score", 2).alias("z_score"),
            "sample_count",
        )
    )


def stage_limit(t: Thresholds, stage: Column | None = None) -> Column:
    """Limit of the row's stage, null for a stage without one. The table of limits is a literal."""
    pairs = [F.lit(x) for name, limit in t.limits.items() for x in (name, float(limit))]
    column = F.col("stage") if stage is None else stage
    return F.element_at(F.create_map(*pairs), column) if pairs else F.lit(None).cast("double")


def limit_breaches(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    """Successful runs that took longer than their stage may; a stage without limit never breaches."""
    limited = _recent(history, as_of, t.window_hours).withColumn("sla_limit", stage_limit(t))
    extra = F.col("end_time") if "end_time" in history.columns else F.lit(None).cast("timestamp")
    return limited.where((F.col("status") == "success") & (F.col("duration_seconds") > F.col("sla_limit"))).select(
        "execution_id", "dataflow_id", "stage", "duration_seconds",
        F.round(F.col("duration_seconds") / 60, 1).alias("duration_minutes"),
        "sla_limit", "start_time", extra.alias("end_time"), "rows_processed",
    )


def success_rates(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    """Runs and success rate per dataflow and stage over the rate window."""
    percent = F.count_if(F.col("status") == "success") * F.lit(100.0) / F.count(F.lit(1))
    return _recent(history, as_of, t.rate_hours).groupBy("dataflow_id", "stage").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.round(percent, 2).alias("success_rate_pct"),
    )


def low_success_rates(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    """Pipelines with enough runs and too low a rate."""
    return success_rates(history, as_of, t).where(
        (F.col("total_runs") >= t.min_runs) & (F.col("success_rate_pct") < t.rate)
    )


def stale_pipelines(
    history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds(), frequencies: DataFrame | None = None
) -> DataFrame:
    """Pipelines whose last success is more than ``stale_hours`` whole hours ago.

    ``frequencies`` (dataflow_id, expected_seconds) replaces the limit for the dataflows it lists.
    """
    now = moment_like(history, "start_time", as_of)
    done = until(history.where(F.col("status") == "success"), as_of)
    last = done.groupBy("dataflow_id", "stage").agg(F.max("start_time").alias("last_run_time"))
    aged = last.withColumn("hours_since_last_run", F.timestamp_diff("HOUR", F.col("last_run_time"), now))
    if frequencies is None:
        return aged.where(F.col("hours_since_last_run") > t.stale_hours)
    age = F.timestamp_diff("SECOND", F.col("last_run_time"), now)
    stale = F.when(F.col("expected_seconds").isNotNull(), age > F.col("expected_seconds")).otherwise(
        F.col("hours_since_last_run") > t.stale_hours
    )
    return aged.join(frequencies, "dataflow_id", "left").where(stale).drop("expected_seconds")
