"""Daily summaries of the run history that merge, and monitoring from one scan of the recent runs.

Per day, dataflow and stage one row holds how many runs there were and how they ended, and of the rows that successful
runs processed the number, mean and sum of squared deviations. Two such rows merge into that of both days by the
parallel-variance rule, in any order. So a monitoring run reads the runs since the last folded day, a small row per day
for the baseline, and the last success of each stage as it was at the last fold, but never the whole history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf, moment, moment_like
from oreflow.functions.schema import struct
from oreflow.plans.history import RUN_DATE, SETTLE, until
from oreflow.plans.monitor import Thresholds, stage_limit
from oreflow.sources.readers import open_table

KEYS = ["dataflow_id", "stage"]
FOLDS = struct({"upto": "date", "number": "bigint"})


def _counted() -> Column:
    """Rows of a run that counts for the baseline: successful, with a number of rows."""
    return F.when(F.col("status") == "success", F.col("rows_processed"))


def _moments(counted: Column) -> list[Column]:
    n = F.count(counted)
    return [n.alias("n"), F.coalesce(F.avg(counted), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(counted) * n, F.lit(0.0)).alias("m2")]


def day_moments(runs: DataFrame) -> DataFrame:
    """Per day, dataflow and stage: runs, succeeded, failed, n, mean and m2 of the rows, last_success."""
    day = F.col(RUN_DATE) if RUN_DATE in runs.columns else F.to_date("start_time")
    return runs.groupBy(day.alias(RUN_DATE), *KEYS).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"), *_moments(_counted()),
        F.max(F.when(F.col("status") == "success", F.col("start_time"))).alias("last_success"),
    )


def _merge(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets as those of their union; an empty set changes nothing."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    share = b["n"] / F.nullif(n.cast("double"), F.lit(0.0))
    return F.struct(
        n.alias("n"), F.coalesce(a["mean"] + apart * share, F.lit(0.0)).alias("mean"),
        F.coalesce(a["m2"] + b["m2"] + apart * apart * a["n"] * share, F.lit(0.0)).alias("m2"))


def without(moments: Column, x: Column) -> Column:
    """Moments of a set without one of its values."""
    n = moments["n"] - 1
    mean = F.coalesce((moments["mean"] * moments["n"] - x) / F.nullif(n.cast("double"), F.lit(0.0)), F.lit(0.0))
    m2 = F.greatest(moments["m2"] - (x - moments["mean"]) * (x - mean), F.lit(0.0))
    return F.struct(n.alias("n"), mean.alias("mean"), F.when(n > 0, m2).otherwise(0.0).alias("m2"))


def merged_moments(moments: DataFrame) -> DataFrame:
    """One row per dataflow and stage of the moments of several days; as many rows meet as there are days."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return moments.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in ("runs", "succeeded", "failed")],
        F.reduce(F.collect_list(F.struct("n", "mean", "m2")), zero, _merge).alias("moments"), F.max("last_success").alias("last_success"),
    ).select(*KEYS, "runs", "succeeded", "failed", "moments.*", "last_success")


class FoldedHistory:
    """Folded days of a run history, below ``path``.

    ``days`` holds the moments by day, ``latest/number=N`` the last success of each stage as of fold N, ``folds`` the last
    day and number of each fold that is complete. A fold that died halfway is made again and replaces what it left. Runs
    that took longer than SETTLE days are not in the days, which may have been folded before they ended: they are in
    ``late`` (see ``is_late``), whole, as well as in the history.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def last(self, before: Column | None = None) -> tuple[dt.date, int] | None:
        """Last day and number of the newest fold, or of the newest whose days all lie before a moment."""
        folds = open_table(self.spark, f"{self.path}/folds", schema=FOLDS)
        if folds is None:
            return None
        folds = folds if before is None else folds.where(F.col("upto") < before.cast("date"))
        row = folds.agg(F.max(F.struct("upto", "number")).alias("last")).first()
        return (row["last"]["upto"], row["last"]["number"]) if row["last"] else None

    def fold(self, history: DataFrame, as_of: AsOf = None) -> dt.date | None:
        """Fold the settled days that no fold has covered yet; the last folded day. The first fold reads all history.

        ``history`` has a ``run_date`` (as the stored history has), so that only the new days are read.
        """
        last = self.last()
        upto = self.spark.range(1).select(F.date_sub(moment(as_of).cast("date"), SETTLE + 2).alias("d")).first()["d"]
        if last and upto <= last[0]:
            return last[0]
        runs = history.where((F.col(RUN_DATE) <= F.lit(upto)) & ~is_late())
        if last:
            runs = runs.where(F.col(RUN_DATE) > F.lit(last[0]))
        number = last[1] + 1 if last else 1
        days = day_moments(runs)
        days.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DATE).parquet(f"{self.path}/days")
        new = self.days(last[0] if last else None, upto)
        found = [d.select(*KEYS, "last_success") for d in (new, self.latest(last[1]) if last else None, self._late_days(upto)) if d is not None]
        if not found:
            return None
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        whole = whole.groupBy(*KEYS).agg(F.max("last_success").alias("last_success"))
        whole.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/latest/number={number}")
        row = self.spark.range(0, 1, 1, 1).select(F.lit(upto).alias("upto"), F.lit(number).cast("long").alias("number"))
        row.write.mode("append").parquet(f"{self.path}/folds")
        return upto

    def days(self, after: dt.date | None, upto: dt.date) -> DataFrame | None:
        held = open_table(self.spark, f"{self.path}/days")
        if held is None:
            return None
        held = held.where(F.col(RUN_DATE) <= F.lit(upto))
        return held if after is None else held.where(F.col(RUN_DATE) > F.lit(after))

    def latest(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/latest/number={number}")

    def late(self) -> DataFrame | None:
        return open_table(self.spark, f"{self.path}/late")

    def _late_days(self, upto: dt.date) -> DataFrame | None:
        held = self.late()
        return None if held is None else day_moments(held.where(F.col(RUN_DATE) <= F.lit(upto)))


def is_late() -> Column:
    """A run that ended so long after its day that the day may have been folded."""
    ended = F.coalesce(F.col("end_time"), F.col("start_time")).cast("date")
    return F.datediff(ended, F.col(RUN_DATE)) > SETTLE


def digest(history: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds(), folded: FoldedHistory | None = None) -> DataFrame:
    """All that the checks need, from one scan of the runs: a row per dataflow and stage, and a row per run that failed or
    breached its limit within the window (``run``, else null).

    The scan is one aggregation with partial sums; listed runs are groups of their own, so a stage with a third of all
    runs is one row per task. With ``folded`` it covers the days after the last fold and those of the windows.
    """
    now = moment_like(history, "start_time", as_of)
    kind = history.select("start_time").schema[0].dataType.simpleString()
    window, rates = (now - F.expr(f"INTERVAL {int(h)} HOURS") for h in (t.window_hours, t.rate_hours))
    first_day = F.date_sub(now.cast("date"), t.history_days)
    last = folded.last(moment(as_of)) if folded else None
    runs = until(history, as_of)
    day = F.col(RUN_DATE) if RUN_DATE in runs.columns else F.to_date("start_time")
    recent, base = F.lit(True), F.lit(True)
    if last:
        base = day > F.lit(last[0])
        runs = runs.where(day >= F.least(F.date_add(F.lit(last[0]), 1), window.cast("date"), rates.cast("date")))
    runs = runs.withColumns({"_recent": recent, "_base": base})
    late = folded.late() if last else None
    if late is not None:
        late = until(late.where(F.col(RUN_DATE) <= F.lit(last[0])), as_of)
        runs = runs.unionByName(late.withColumns({"_recent": F.lit(False), "_base": F.lit(True)}), allowMissingColumns=True)
    if "end_time" not in runs.columns:
        runs = runs.withColumn("end_time", F.lit(None).cast(kind))
    start, good = F.col("start_time"), F.col("status") == "success"
    runs = runs.withColumn("sla_limit", stage_limit(t))
    inside, rated = F.col("_recent") & (start >= window), F.col("_recent") & (start >= rates)
    failed = inside & (F.col("status") == "failed")
    breached = inside & good & (F.col("duration_seconds") > F.col("sla_limit"))
    listed = F.coalesce(failed, F.lit(False)) | F.coalesce(breached, F.lit(False))
    run = F.struct(
        failed.alias("failed"), breached.alias("breached"), "execution_id", "error_message", "start_time", "end_time", "duration_seconds",
        "sla_limit", "rows_processed")
    own = F.monotonically_increasing_id()  # equal runs stay apart
    runs = runs.select("*", F.explode(F.when(listed, F.array(F.lit(None).cast("long"), own)).otherwise(F.array(F.lit(None).cast("long")))).alias("_own"))
    tested = F.when(inside & good & F.col("rows_processed").isNotNull(), F.struct("start_time", "execution_id", "rows_processed"))
    counted = F.when(F.col("_base") & (start >= first_day.cast(kind)), _counted())
    found = runs.groupBy(*KEYS, "_own").agg(
        F.max_by(F.when(F.col("_own").isNotNull(), run), start).alias("run"),
        F.count_if(rated).alias("total_runs"), F.count_if(rated & good).alias("success_count"),
        F.count_if(rated & (F.col("status") == "failed")).alias("failed_count"), F.max(tested).alias("tested"), *_moments(counted),
        F.max(F.when(F.col("_base") & good, start)).alias("last_success"),
    ).drop("_own")
    if last is None:
        return found.select("*", F.struct("n", "mean", "m2").alias("moments")).drop("n", "mean", "m2")
    days = folded.days(None, last[0])
    days = merged_moments(days.where(F.col(RUN_DATE) >= first_day)).select(*KEYS, F.struct("n", "mean", "m2").alias("_held")) if days is not None else None
    latest = folded.latest(last[1]).select(*KEYS, F.col("last_success").cast(kind).alias("_last"), F.lit(True).alias("_known"))
    held = latest if days is None else latest.join(days, KEYS, "left")
    held = held if days is not None else held.withColumn("_held", F.lit(None).cast("struct<n:bigint,mean:double,m2:double>"))
    # Stages without recent runs have a row too; listed runs take none of what was folded.
    whole = found.withColumn("_known", F.col("run").isNull()).join(held, [*KEYS, "_known"], "full_outer")
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    mine = F.when(F.col("n").isNotNull(), F.struct("n", "mean", "m2")).otherwise(empty)
    return whole.select(
        *KEYS, "run", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_runs", "success_count", "failed_count")], "tested",
        F.greatest("last_success", "_last").alias("last_success"),
        F.when(F.col("_held").isNotNull(), _merge(mine, F.col("_held"))).otherwise(mine).alias("moments"),
    )


def failures(found: DataFrame) -> DataFrame:
    """Of a digest, what ``monitor.recent_failures`` finds; so for the four below and their checks."""
    return found.where("run.failed").select("run.execution_id", *KEYS, "run.error_message", "run.start_time", "run.duration_seconds")


def breaches(found: DataFrame) -> DataFrame:
    rows = found.where("run.breached").select(*KEYS, "run.*")
    return rows.select(
        "execution_id", *KEYS, "duration_seconds", F.round(F.col("duration_seconds") / 60, 1).alias("duration_minutes"), "sla_limit",
        "start_time", "end_time", "rows_processed")


def anomalies(found: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    rows, x = found.where(F.col("run").isNull() & F.col("tested").isNotNull()), F.col("tested.rows_processed")
    rows = rows.withColumn("_m", without(F.col("moments"), x) if t.exclude_latest else F.col("moments"))
    spread = F.sqrt(F.col("_m.m2") / F.nullif(F.col("_m.n") - 1, F.lit(0)))
    rows = rows.where(F.col("_m.n") >= t.min_samples).withColumn("_spread", spread).where(F.col("_spread") > 0)
    rows = rows.withColumn("_score", (x - F.col("_m.mean")) / F.col("_spread")).where(F.abs("_score") > t.z)
    return rows.select(
        *KEYS, x.alias("latest_rows"), F.round("_m.mean", 2).alias("historical_avg"), F.round("_spread", 2).alias("historical_stddev"),
        F.col("tested.start_time").alias("latest_run_time"), F.round("_score", 2).alias("z_score"), F.col("_m.n").alias("sample_count"))


def low_rates(found: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    percent = F.round(F.col("success_count") * F.lit(100.0) / F.col("total_runs"), 2)
    rows = found.where(F.col("run").isNull() & (F.col("total_runs") >= F.lit(max(1, t.min_runs))))
    return rows.select(*KEYS, "total_runs", "success_count", "failed_count", percent.alias("success_rate_pct")).where(F.col("success_rate_pct") < t.rate)


def stale(found: DataFrame, as_of: AsOf = None, t: Thresholds = Thresholds()) -> DataFrame:
    now = moment_like(found, "last_success", as_of)
    rows = found.where(F.col("run").isNull() & F.col("last_success").isNotNull())
    return rows.select(
        *KEYS, F.col("last_success").alias("last_run_time"), F.timestamp_diff("HOUR", F.col("last_success"), now).alias("hours_since_last_run"),
    ).where(F.col("hours_since_last_run") > t.stale_hours)
