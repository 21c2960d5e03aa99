import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from oreflow.plans import alerts as al
from oreflow.plans import history as hi
from oreflow.plans import moments as mo
from oreflow.plans import monitor as m
from oreflow.plans.monitor import Thresholds

NOW = dt.datetime(2024, 3, 15, 12, 0)
DAY = dt.timedelta(days=1)


def history(spark, seed, n=400):
    """Runs of some stages over 60 days, a third of them of one stage; some last for days, some lie in the future."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        flow = "busy" if rng.random() < 0.34 else f"f{rng.randrange(5)}"
        stage = "bronze" if flow == "busy" else rng.choice(["rdb_ingestion", "bronze", "silver", "other"])
        start = NOW + DAY - dt.timedelta(seconds=rng.randrange(60 * 86400))
        seconds = rng.choice([10.0, 700.0, 2000.0, 4.5 * 86400]) if rng.random() < 0.9 else None
        good = rng.random() < 0.7
        end = None if seconds is None else start + dt.timedelta(seconds=seconds)
        n_rows = rng.choice([None, 100, 120, 90, 5000]) if good else None
        rows.append((str(i), flow, "g", stage, "success" if good else rng.choice(["failed", "failed", "running"]), start, end, seconds, n_rows, None if good else "e", {}, start))
    rows += [("old", "gone", "g", "bronze", "success", NOW - 55 * DAY, NOW - 55 * DAY, 1.0, 7, None, {}, NOW)]
    return spark.createDataFrame(rows, hi.RUN_HISTORY).withColumn(hi.RUN_DATE, F.to_date("start_time"))


def stored(frame, root):
    frame.write.partitionBy(hi.RUN_DATE).parquet(f"{root}/runs")
    late = frame.where(mo.is_late())
    late.write.parquet(f"{root}/days/late")
    return frame.sparkSession.read.parquet(f"{root}/runs"), mo.FoldedHistory(frame.sparkSession, f"{root}/days")


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def five(found, t, as_of=NOW):
    return [mo.failures(found), mo.anomalies(found, t), mo.breaches(found), mo.low_rates(found, t), mo.stale(found, as_of, t)]


def direct(runs, t, as_of=NOW):
    return [m.recent_failures(runs, as_of, t), m.row_anomalies(runs, as_of, t), m.limit_breaches(runs, as_of, t), m.low_success_rates(runs, as_of, t), m.stale_pipelines(runs, as_of, t)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("t", [
    Thresholds(window_hours=240, z=0.5, rate_hours=200, rate=90.0), Thresholds(window_hours=48, z=0.3, exclude_latest=True, min_samples=2),
], ids=["wide", "narrow"])
def test_the_digest_gives_what_the_checks_give(spark, tmp_path, seed, t):
    runs, folded = stored(history(spark, seed), tmp_path)
    wanted = [rows_of(f) for f in direct(runs, t)]
    assert all(wanted[:2]) and wanted[4]
    assert [rows_of(f) for f in five(mo.digest(runs, NOW, t), t)] == wanted
    assert folded.fold(runs, NOW - 20 * DAY) == (NOW - 24 * DAY).date()
    assert [rows_of(f) for f in five(mo.digest(runs, NOW, t, folded), t)] == wanted
    assert folded.fold(runs, NOW) == (NOW - 4 * DAY).date() == folded.fold(runs, NOW)
    assert [rows_of(f) for f in five(mo.digest(runs, NOW, t, folded), t)] == wanted
    # As of a moment before the last fold, the fold before it is used.
    early = NOW - 10 * DAY
    assert [rows_of(f) for f in five(mo.digest(runs, early, t, folded), t, early)] == [rows_of(f) for f in direct(runs, t, early)]


def test_a_folded_run_reads_the_last_days_once(spark, tmp_path):
    runs, folded = stored(history(spark, 5), tmp_path)
    folded.fold(runs, NOW)
    found = mo.digest(runs, NOW, Thresholds(), folded)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")]
    scans = [line for line in plan.split("\n") if "Scan" in line and "/runs]" in line]
    assert len(scans) == 1 and "PartitionFilters" in scans[0]
    whole = mo.digest(runs, NOW)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("FileScan") == 1 and whole.count("Exchange hashpartitioning") == 1


def test_moments_of_days_merge_to_those_of_all(spark):
    runs = history(spark, 7)
    merged = {(r["dataflow_id"], r["stage"]): r for r in mo.merged_moments(mo.day_moments(runs)).collect()}
    for key in {(r["dataflow_id"], r["stage"]) for r in runs.collect()}:
        mine = [r for r in runs.collect() if (r["dataflow_id"], r["stage"]) == key]
        values = [r["rows_processed"] for r in mine if r["status"] == "success" and r["rows_processed"] is not None]
        got = merged[key]
        assert (got["runs"], got["n"]) == (len(mine), len(values))
        if values:
            assert got["mean"] == pytest.approx(statistics.fmean(values)) and got["m2"] == pytest.approx(statistics.pvariance(values) * len(values))
        good = [r["start_time"] for r in mine if r["status"] == "success"]
        assert got["last_success"] == (max(good) if good else None)


def test_a_fold_that_died_is_made_again(spark, tmp_path):
    runs, folded = stored(history(spark, 8), tmp_path)
    folded.fold(runs, NOW - 20 * DAY)
    # Days of the next fold are there, but the fold was never entered.
    mo.day_moments(runs.where(F.col(hi.RUN_DATE) > (NOW - 24 * DAY).date())).withColumn("runs", F.lit(99)).write.mode("append").partitionBy(hi.RUN_DATE).parquet(f"{tmp_path}/days/days")
    folded.fold(runs, NOW)
    t = Thresholds(window_hours=48, z=0.3)
    assert [rows_of(f) for f in five(mo.digest(runs, NOW, t, folded), t)] == [rows_of(f) for f in direct(runs, t)]


def test_a_value_is_taken_out_of_moments(spark):
    row = spark.range(1).select(mo.without(F.struct(F.lit(3).alias("n"), F.lit(4.0).alias("mean"), F.lit(14.0).alias("m2")), F.lit(7)).alias("m")).first()["m"]
    assert row["n"] == 2 and row["mean"] == 2.5 and row["m2"] == pytest.approx(0.5)
    alone = spark.range(1).select(mo.without(F.struct(F.lit(1).alias("n"), F.lit(4.0).alias("mean"), F.lit(0.0).alias("m2")), F.lit(4)).alias("m")).first()["m"]
    assert (alone["n"], alone["mean"], alone["m2"]) == (0, 0.0, 0.0)


def test_equal_runs_are_all_listed_and_an_empty_history_gives_nothing(spark):
    runs = history(spark, 9, 0).limit(0)
    row = ("x", "f", "g", "bronze", "failed", NOW, NOW, 1.0, None, "e", {}, NOW)
    twice = spark.createDataFrame([row, row], hi.RUN_HISTORY)
    assert mo.failures(mo.digest(twice, NOW)).count() == 2
    assert mo.digest(runs, NOW).count() == 0


def test_run_checks_falls_back_to_single_checks(spark, tmp_path):
    broken = history(spark, 3).drop("error_message")
    found = {r["alert_type"] for r in al.run_checks(broken, f"{tmp_path}/alerts", NOW, Thresholds(window_hours=240)).collect()}
    assert "Monitoring Error" in found and "Data Freshness" in found


def test_a_late_run_is_kept_beside_the_history(spark, tmp_path):
    run = hi.StageRun(spark, f"{tmp_path}/runs", "f", "bronze", late_path=f"{tmp_path}/late")
    run.__enter__()
    run.start -= 4 * DAY
    run.__exit__(None, None, None)
    with hi.StageRun(spark, f"{tmp_path}/runs", "f", "bronze", late_path=f"{tmp_path}/late"):
        pass
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 2 and spark.read.parquet(f"{tmp_path}/late").count() == 1
