"""Metadata tables: run history, lineage, metadata versions, monitoring history, and the views over them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from types import TracebackType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf, moment, moment_like
from oreflow.functions.rows import row_hash
from oreflow.functions.schema import MapOf, struct
from oreflow.operators.dedup import latest_by

# The four metadata tables; "!" marks columns that are never null.
RUN_HISTORY = struct({
    "execution_id!": "string", "dataflow_id!": "string", "dataflow_group!": "string", "stage!": "string",
    "status!": "string", "start_time!": "timestamp", "end_time": "timestamp", "duration_seconds": "double",
    "rows_processed": "bigint", "error_message": "string", "metadata": MapOf(), "created_at!": "timestamp",
})
DATA_LINEAGE = struct({
    "lineage_id!": "string", "dataflow_id!": "string", "source_system": "string", "source_table": "string",
    "target_table!": "string", "transformation_logic": "string", "execution_id": "string",
    "created_at!": "timestamp", "updated_at!": "timestamp",
})
METADATA_VERSIONS = struct({
    "version_id!": "string", "dataflow_id!": "string", "metadata_content!": "string",
    "change_description": "string", "created_by!": "string", "created_at!": "timestamp", "is_active": "boolean",
})
MONITORING_HISTORY = struct({
    "run_id": "string", "monitoring_timestamp!": "timestamp", "monitoring_date!": "date", "monitoring_window_hours": "int",
    "alert_count": "int", "critical_count": "int", "warning_count": "int", "alerts_json": "string",
    "created_at": "timestamp",
})
#: Days that a run may take before it counts as late: its day may have been folded by then.
SETTLE = 2
#: Day a run started on, which the stored run history is partitioned by.
RUN_DATE = "run_date"
TABLES = {
    "pipeline_execution_history": (RUN_HISTORY, ()),
    "data_lineage": (DATA_LINEAGE, ()),
    "metadata_versions": (METADATA_VERSIONS, ()),
    "monitoring_history": (MONITORING_HISTORY, ("monitoring_date",)),
}


def create_metadata_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Create the database and the metadata tables that do not exist yet; returns the table names."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    names = []
    for name, (schema, partitions) in TABLES.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")
        names.append(f"{database}.{name}")
    return names


def run_records(
    runs: DataFrame, metadata: Column | None = None, created_at: AsOf = None
) -> DataFrame:
    """Finished runs as history rows: end, duration, rows and error filled where the status has them."""
    seconds = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / F.lit(1e6)
    return runs.select(
        "execution_id", "dataflow_id", "dataflow_group", "stage", "status", "start_time", "end_time",
        seconds.alias("duration_seconds"),
        F.when(F.col("status") == "success", F.col("rows_processed")).alias("rows_processed"),
        "error_message",
        (metadata if metadata is not None else F.create_map().cast("map<string,string>")).alias("metadata"),
        moment(created_at).alias("created_at"),
    )


def throughput(history: DataFrame) -> DataFrame:
    """Rows per second of each successful run; null for runs without measurable time."""
    rate = F.col("rows_processed") / F.nullif(F.col("duration_seconds"), F.lit(0.0))
    return history.where(F.col("status") == "success").select(
        "execution_id", "dataflow_id", "stage", "rows_processed", "duration_seconds",
        F.round(rate, 2).alias("rows_per_second"),
    )


class StageRun:
    """Records one stage run, successful or failed, as a history row.

    ``with StageRun(...) as run: ...; run.rows = n``. An error inside is recorded and raised again.
    """

    def __init__(
        self, spark: SparkSession, history_path: str, dataflow_id: str, stage: str, dataflow_group: str = "",
        metadata: Mapping[str, str] | None = None, late_path: str | None = None,
    ):
        self.spark, self.history_path, self.late_path = spark, history_path, late_path
        self.dataflow_id, self.stage, self.dataflow_group = dataflow_id, stage, dataflow_group
        self.metadata = dict(metadata or {})
        self.execution_id = str(uuid.uuid4())
        self.rows: int | None = None
        self.status = "running"

    def __enter__(self) -> StageRun:
        self.start = dt.datetime.now(dt.timezone.utc)
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> bool:
        end = dt.datetime.now(dt.timezone.utc)
        self.status = "failed" if error else "success"
        self.duration = (end - self.start).total_seconds()
        row = (
            self.execution_id, self.dataflow_id, self.dataflow_group, self.stage, self.status, self.start, end,
            self.duration, None if error else self.rows, str(error) if error else None, self.metadata, end,
        )
        record = self.spark.createDataFrame([row], RUN_HISTORY).withColumn(RUN_DATE, F.lit(self.start.date()))
        record.coalesce(1).write.mode("append").partitionBy(RUN_DATE).parquet(self.history_path)
        if self.late_path and (end.date() - self.start.date()).days > SETTLE:
            record.coalesce(1).write.mode("append").parquet(self.late_path)  # its day may have been folded by now
        return False


def lineage_edges(specs: DataFrame, execution_id: Column | str | None = None, as_of: AsOf = None) -> DataFrame:
    """One row per stage edge of every dataflow: source → raw, raw → bronze, bronze → silver."""
    def name(stage: str) -> Column:
        return F.concat_ws(".", F.col(f"{stage}.catalog"), F.col(f"{stage}.schema"), F.col(f"{stage}.table"))

    system = F.element_at(F.col("source.connection"), "connection_name")
    origin = F.coalesce(F.col("source.extraction.log"), F.element_at(F.col("source.connection"), "source_table"))

    def edge(source: Column, target: str, logic: Column) -> Column:
        return F.struct(
            source.alias("source_table"), name(target).alias("target_table"), logic.alias("transformation_logic")
        )

    edges = F.array(
        edge(origin, "raw_bronze", F.col("source.extraction.main_query")),
        edge(name("raw_bronze"), "bronze", F.to_json(F.struct(F.col("bronze.transformations")))),
        edge(name("bronze"), "silver", F.to_json(F.struct(
            F.col("silver.transformations"), F.col("silver.cdc_apply_changes")
        ))),
    )
    if not isinstance(execution_id, Column):
        execution_id = F.lit(execution_id).cast("string")
    rows = specs.select("dataflow_id", system.alias("source_system"), F.inline(edges))
    return rows.where(F.col("target_table") != "").select(
        F.sha2(F.concat_ws("|", "dataflow_id", "source_table", "target_table"), 256).alias("lineage_id"),
        "dataflow_id", "source_system", "source_table", "target_table", "transformation_logic",
        execution_id.alias("execution_id"), moment(as_of).alias("created_at"), moment(as_of).alias("updated_at"),
    )


def current_lineage(lineage: DataFrame) -> DataFrame:
    """The newest row of each lineage id; every run may add rows, an edge counts once."""
    times = [f"{c} DESC" for c in ("updated_at", "created_at") if c in lineage.columns]
    edge = ["lineage_id"] if "lineage_id" in lineage.columns else ["dataflow_id", "source_table", "target_table"]
    return latest_by(lineage, edge, [*times, row_hash(lineage).desc()])


def new_lineage(edges: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Edges that are not stored yet, or whose source or logic has changed; a known edge keeps its creation time."""
    if stored is None:
        return edges
    known = current_lineage(stored).select(
        F.col("lineage_id").alias("_id"), F.col("source_system").alias("_system"),
        F.col("transformation_logic").alias("_logic"), F.col("created_at").alias("_created"))
    pairs = edges.join(known, F.col("lineage_id") == F.col("_id"), "left")
    same = F.col("source_system").eqNullSafe(F.col("_system")) & F.col("transformation_logic").eqNullSafe(F.col("_logic"))
    changed = pairs.where(F.col("_id").isNull() | ~same)
    return changed.withColumn("created_at", F.coalesce("_created", "created_at")).select(*edges.columns)


def metadata_versions(
    specs: DataFrame, created_by: str, description: str | None = None, as_of: AsOf = None
) -> DataFrame:
    """A version row per dataflow; the id is the hash of the content, so unchanged metadata keeps its version.

    Which version is active follows from all of them (``with_active_flag``), so the stored flag is null.
    """
    content = F.to_json(F.struct(*specs.columns))
    return specs.select(
        F.sha2(content, 256).alias("version_id"), "dataflow_id", content.alias("metadata_content"),
        F.lit(description).cast("string").alias("change_description"), F.lit(created_by).alias("created_by"),
        moment(as_of).alias("created_at"), F.lit(None).cast("boolean").alias("is_active"),
    )


def new_versions(proposed: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Versions that differ from the active one, so going back to an earlier content is a version again."""
    if stored is None:
        return proposed
    active = active_versions(stored).select(F.col("dataflow_id").alias("_flow"), F.col("version_id").alias("_version"))
    same = (F.col("dataflow_id") == F.col("_flow")) & (F.col("version_id") == F.col("_version"))
    return proposed.join(active, same, "left_anti")


def changed_versions(proposed: DataFrame) -> DataFrame:
    """Of versions proposed over time those that differ from the one before, per dataflow."""
    before = F.lag("version_id").over(Window.partitionBy("dataflow_id").orderBy("created_at", "version_id"))
    marked = proposed.withColumn("_before", before)
    return marked.where(~F.col("version_id").eqNullSafe(F.col("_before"))).drop("_before")


def with_active_flag(versions: DataFrame) -> DataFrame:
    """Mark the newest version of each dataflow.

    All rows stay, so the newest is found first, cut down before its shuffle, and joined back. The join key is the
    whole identity of a version, which spreads the versions of a busy dataflow over all tasks; a window over all
    rows, or a join on the dataflow alone, would bring them into one.
    """
    identity = ["dataflow_id", "created_at", "version_id"]
    newest = latest_by(versions.select(*identity), identity[:1], ["created_at DESC", "version_id DESC"])
    marked = versions.join(newest.withColumn("_active", F.lit(True)), identity, "left")
    return marked.withColumn("is_active", F.coalesce("_active", F.lit(False))).select(*versions.columns)


def active_versions(versions: DataFrame) -> DataFrame:
    """The newest version of each dataflow."""
    newest = latest_by(versions, ["dataflow_id"], ["created_at DESC", "version_id DESC"])
    return newest.withColumn("is_active", F.lit(True))


def until(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Runs that have started by ``as_of``; all without one."""
    if as_of is None:
        return history
    runs = history.where(F.col("start_time") <= moment_like(history, "start_time", as_of))
    return runs.where(F.col(RUN_DATE) <= moment(as_of).cast("date")) if RUN_DATE in history.columns else runs


def latest_status(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The latest run per dataflow and stage."""
    newest = latest_by(until(history, as_of), ["dataflow_id", "stage"], ["start_time DESC", "execution_id DESC"])
    return newest.select(
        # The columns of both views.
        "dataflow_id", "stage", "status", "start_time", "end_time", "duration_seconds", "rows_processed",
        "error_message",
    )


def complete_dataflow(lineage: DataFrame, history: DataFrame) -> DataFrame:
    """Lineage with the latest status: one row per lineage id and stage that ever ran."""
    lineage = current_lineage(lineage)
    status = latest_status(history).select("dataflow_id", "status", "start_time", "end_time", "rows_processed")
    return lineage.join(status, "dataflow_id", "left").select(
        "dataflow_id", "source_system", "source_table", "target_table", "status", "start_time", "end_time",
        "rows_processed",
    )


def create_views(spark: SparkSession, history: DataFrame, lineage: DataFrame) -> None:
    """Both views as temporary views of the session."""
    latest_status(history).createOrReplaceTempView("v_latest_pipeline_status")
    complete_dataflow(lineage, history).createOrReplaceTempView("v_complete_dataflow")
