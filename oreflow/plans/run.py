"""Run whole dataflows: ingest, bronze, silver, validate, with run history, lineage and versions recorded."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.clock import moment
from oreflow.functions.params import query_values, render
from oreflow.functions.schema import struct
from oreflow.operators.joins import conform
from oreflow.operators.quality import QualityResult, event_log, raise_offenders, reprocess
from oreflow.operators.validation import TableChecks, validate
from oreflow.plans.alerts import at_level, chat_payloads, monitoring_alerts, monitoring_history, monitoring_status, run_checks
from oreflow.plans.flows import (
    BronzeFlow, SilverFlow, bronze, bronze_flow_of, deduplication_of, file_format, ingest, silver_flow_of, silver_of,
    writer_options,
)
from oreflow.plans.history import (
    RUN_DATE, RUN_HISTORY, StageRun, lineage_edges, metadata_versions, new_lineage, new_versions,
)
from oreflow.plans.moments import FoldedHistory
from oreflow.plans.monitor import Thresholds
from oreflow.plans.spec import SPEC_SCHEMA, bronze_specs, silver_specs
from oreflow.sources.readers import open_table, read_jdbc, read_source
from oreflow.sources.sinks import ClusterRanges, read_merged, write_table
from oreflow.sources.target import BATCH, SOURCE, ChangeTarget, LatestRows
from oreflow.streaming.flows import FLOW, SilverBatches, WrittenRows, append_flow_streams, bronze_stream, observed, silver_stream

#: Folders of a raw table, one for each chain of stages that appended to it.
CHAIN = "_chain"
#: Name of a bronze table's own source among those appended to it.
MAIN_FLOW = "main"
#: Folder in which a file sink lists its files; readers of a table that has one see no others.
SINK_LOG = "_spark_metadata"
LAYERS = {"bronze": ("bronze",), "silver": ("silver",), "bronze_silver": ("bronze", "silver")}


class Workspace:
    """Where the tables of a set of dataflows live: one folder that all executors share.

    A full refresh never deletes: it moves a layer to its next generation, a fresh table with a fresh checkpoint.
    Silver tables with change rules are compacted after ``compact_every`` batches; ``buckets`` gives them bucketed
    bases (see ``ChangeTarget``).
    """

    def __init__(self, spark: SparkSession, root: str, compact_every: int = 10, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.compact_every, self.buckets = compact_every, buckets

    def path(self, details: Mapping[str, str]) -> str:
        return "/".join([self.root, details["catalog"], details["database"], details["table"]])

    def metadata(self, name: str, dataflow_id: str | None = None) -> str:
        """Folder of a metadata table, or the part of it that one dataflow writes to.

        Two jobs that append to the same folder can remove each other's unfinished files, so dataflows that run
        side by side keep to folders of their own.
        """
        base = f"{self.root}/metadata/{name}"
        return base if dataflow_id is None else f"{base}/{FLOW}={quote(dataflow_id, safe='')}"

    def read_metadata(self, name: str) -> DataFrame | None:
        """A metadata table over all dataflows."""
        if name == "pipeline_execution_history":
            # Its schema is fixed, so no file is opened to find it, and filters on the day leave out whole folders.
            schema = T.StructType([*RUN_HISTORY.fields, T.StructField(FLOW, T.StringType()), T.StructField(RUN_DATE, T.DateType())])
            held = open_table(self.spark, self.metadata(name), schema=schema)
        else:
            held = open_table(self.spark, self.metadata(name), mergeSchema="true")
        return None if held is None else held.drop(FLOW, SOURCE, BATCH)

    def raw_table(self, spec: Row) -> DataFrame | None:
        """The raw rows of a dataflow, None before its first run."""
        held = open_table(self.spark, self.path(_raw_details(spec)), mergeSchema="true")
        return None if held is None else held.drop(CHAIN)

    def generation(self, dataflow_id: str, layer: str) -> int:
        known = open_table(self.spark, self.metadata("generations", dataflow_id))
        if known is None:
            return 0
        return known.where(F.col("layer") == layer).agg(F.max("generation")).first()[0] or 0

    def next_generation(self, dataflow_id: str, layer: str) -> int:
        number = self.generation(dataflow_id, layer) + 1
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(dataflow_id).alias("dataflow_id"), F.lit(layer).alias("layer"), F.lit(number).alias("generation")
        )
        row.write.mode("append").parquet(self.metadata("generations", dataflow_id))
        return number

    def _version(self, flow: BronzeFlow | SilverFlow, layer: str) -> str:
        """A silver table that only appends cannot take the rows of a rebuilt bronze table a second time, so it
        starts anew with it; applying changes twice does no harm."""
        version = f"g{self.generation(flow.dataflow_id, layer)}"
        if isinstance(flow, SilverFlow) and flow.changes is None:
            version += f"-{self.generation(flow.dataflow_id, 'bronze')}"
        return version

    def layer_path(self, flow: BronzeFlow | SilverFlow, layer: str) -> str:
        return f"{self.path(flow.target)}/{self._version(flow, layer)}"

    def checkpoint(self, flow: BronzeFlow | SilverFlow, layer: str) -> str:
        return f"{self.root}/checkpoints/{quote(flow.dataflow_id, safe='')}/{layer}/{self._version(flow, layer)}"

    def silver_target(self, flow: SilverFlow) -> ChangeTarget | LatestRows | str:
        """What a silver table is kept in: with deduplication the best rows of each key, with change rules a change
        target, else just the path that batches are appended to."""
        path, dedup = self.layer_path(flow, "silver"), deduplication_of(flow)
        if dedup:
            return LatestRows(self.spark, f"{path}_latest", dedup.best, dedup.pick)
        return ChangeTarget(self.spark, path, flow.changes, self.buckets) if flow.changes else path

    def quarantine_path(self, flow: SilverFlow) -> str:
        return f"{self.layer_path(flow, 'silver')}_quarantine"

    def table(self, flow: BronzeFlow | SilverFlow, layer: str) -> DataFrame | None:
        """The current rows of a layer, None before its first run."""
        target = self.silver_target(flow) if layer == "silver" else None
        if isinstance(target, LatestRows):
            held = target.current()
            return None if held is None else silver_of(held, flow)
        if isinstance(target, ChangeTarget):
            return target.current()
        held = open_table(self.spark, self.layer_path(flow, layer), mergeSchema="true")
        return held if held is None else held.drop(SOURCE, BATCH) if layer == "silver" else held.drop(FLOW, BATCH)


@dataclass
class RunResult:
    dataflow_id: str
    rows: dict[str, int | None] = field(default_factory=dict)
    executions: dict[str, str] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)
    validation: DataFrame | None = None
    failed_checks: int | None = None
    #: Stages that an earlier, failed run of the same trigger time had done.
    resumed: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        """The result as JSON text, for the caller of a job."""
        status = None if self.failed_checks is None else "FAILED" if self.failed_checks else "PASSED"
        return json.dumps({
            "dataflow_id": self.dataflow_id, "rows": self.rows, "executions": self.executions, "quality": self.quality,
            "validation_status": status, "failed_checks": self.failed_checks,
        })


class StageLedger:
    """Which stages of a dataflow are done for a trigger time, so that a run repeated after a failure goes on where it
    stopped.

    A chain is closed when all its stages are done; the same trigger time after that is a new chain. Raw rows are
    appended below a folder of the chain, which a repeated ingestion replaces, so a run that dies after the write and
    before its entry here appends nothing twice. One run of a dataflow at a time.
    """

    SCHEMA = struct({
        "trigger_time": "timestamp", "chain": "bigint", "stage": "string", "execution_id": "string", "rows": "bigint",
    })
    CLOSED = "closed"

    def __init__(self, ws: Workspace, dataflow_id: str, trigger_time: dt.datetime):
        self.ws, self.path, self.trigger_time = ws, ws.metadata("stage_ledger", dataflow_id), trigger_time
        held = open_table(ws.spark, self.path, schema=self.SCHEMA)
        # As many rows as the chains of this one trigger time have stages.
        rows = [] if held is None else held.where(F.col("trigger_time") == F.lit(trigger_time)).collect()
        self.chain = sum(r["stage"] == self.CLOSED for r in rows)
        self.done = {r["stage"]: r for r in rows if r["chain"] == self.chain}

    def stamp(self) -> str:
        """A folder name of the chain."""
        return f"{self.trigger_time:%Y%m%dT%H%M%S%f}-{self.chain}"

    def run(self, stage: str, result: RunResult, work: Callable[[], None]) -> None:
        """Carry out a stage, or take its outcome from the run that has done it."""
        if stage in self.done:
            result.rows[stage], result.executions[stage] = self.done[stage]["rows"], self.done[stage]["execution_id"]
            result.resumed.append(stage)
            return
        work()
        self._enter(stage, result.executions.get(stage), result.rows.get(stage))

    def close(self) -> None:
        self._enter(self.CLOSED)

    def _enter(self, stage: str, execution_id: str | None = None, rows: int | None = None) -> None:
        row = self.ws.spark.createDataFrame([(self.trigger_time, self.chain, stage, execution_id, rows)], self.SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)


def source_rows(
    spark: SparkSession, source: Row, trigger_time: dt.datetime, credentials: Mapping[str, str] | None = None
) -> DataFrame:
    """Extracted rows of a spec's source, from the cursor on."""
    extraction, connection = source["extraction"], source["connection"] or {}
    parameters = {k: v.asDict() for k, v in (extraction["parameters"] or {}).items()}
    if source["type"] == "rdb_jdbc":
        options = extraction["read_options"] or {}
        prepare, predicates = extraction["prepare_query"], json.loads(options.get("predicates") or "null")
        if not predicates and not options.get("partitionColumn") and options.get("numPartitions") != "1":
            raise ValueError(
                "this source would be read by one task: give partitionColumn or predicates (a JSON list), or ask for "
                "numPartitions 1")
        return read_jdbc(
            spark,
            partition_column=options.get("partitionColumn"),
            num_partitions=int(options.get("numPartitions", 8)),
            predicates=predicates,
            url=connection["jdbc_url"], driver=connection.get("driver"),
            db_type=connection.get("db_type", "mssql"),
            fetchsize=int(options.get("fetchsize", 1000)),
            prepare_query=render(prepare, trigger_time, parameters) if prepare else None,
            query=render(extraction["main_query"], trigger_time, parameters),
            **(credentials or {}),
        )
    fmt = connection.get("format", "parquet")
    log = read_source(spark, extraction["log"], fmt)
    master = read_source(spark, extraction["master"], fmt) if extraction["master"] else None
    cursor = query_values(trigger_time, parameters).get("start_date")
    return ingest(
        log, master, extraction["log_key"], extraction["master_key"], extraction["cursor_column"], cursor
    )


def _raw_details(spec: Row) -> dict[str, str]:
    raw = spec["raw_bronze"]
    return {"catalog": raw["catalog"], "database": raw["schema"], "table": raw["table"]}


def run_ingestion(
    ws: Workspace, spec: Row, trigger_time: dt.datetime, result: RunResult,
    credentials: Mapping[str, str] | None = None, chain: str | None = None,
) -> None:
    """Extract rows and write them to the raw table. An append goes to a folder named by its chain, which the same chain
    replaces when it comes again; without one to a folder of its own."""
    raw = spec["raw_bronze"]
    with _stage(ws, spec["dataflow_id"], spec["dataflow_group"], "rdb_ingestion", result) as run:
        rows = source_rows(ws.spark, spec["source"], trigger_time, credentials)
        context = {"execution_id": run.execution_id, "dataflow_id": spec["dataflow_id"]}
        rows = ingest(
            rows, metadata_columns=raw["metadata_columns"] or {}, trigger_time=trigger_time, context=context
        )
        if file_format(raw["format"]) != "parquet":
            raise ValueError(f"raw tables are kept in parquet, not in {raw['format']!r}")
        options, ignored = writer_options(raw["table_properties"])
        if ignored:  # properties of a table format; which ones had no effect stands in the history
            run.metadata["ignored_table_properties"] = ", ".join(ignored)
        path, mode = ws.path(_raw_details(spec)), raw["write_mode"] or "append"
        if mode == "append":
            path, mode = f"{path}/{CHAIN}={chain or run.execution_id}", "overwrite"
        run.rows = write_table(
            rows, path, mode, raw["partition_columns"] or (), options=options, balance=bool(raw["partition_columns"]),
        )


def run_bronze(
    ws: Workspace, flow: BronzeFlow, result: RunResult, group: str = "", refresh: bool = False,
    as_of: dt.datetime | None = None,
) -> None:
    if refresh:
        ws.next_generation(flow.dataflow_id, "bronze")
    with _stage(ws, flow.dataflow_id, group, "bronze", result) as run:
        source = ws.path({k.removeprefix("source_"): v for k, v in flow.source.items()})
        # Files appended later may have more columns; the stream takes the merged schema of all of them.
        schema = read_merged(ws.spark, source, flow.file_format()).schema
        raw = read_source(ws.spark, source, flow.file_format(), flow.reader_options, schema, stream=True).drop(CHAIN)
        path, checkpoint = ws.layer_path(flow, "bronze"), ws.checkpoint(flow, "bronze")
        streams = {MAIN_FLOW: raw} | {f["name"]: _appended(ws, flow, f) for f in flow.append_flows}
        if len(streams) != 1 + len(flow.append_flows):
            raise ValueError(f"the sources of {flow.dataflow_id} need names of their own, other than {MAIN_FLOW}")
        rows = {name: bronze(stream, flow, as_of) for name, stream in streams.items()}
        if flow.cluster_by:
            if open_table(ws.spark, f"{path}/{SINK_LOG}/*", "binaryFile") is not None:
                raise ValueError(f"the bronze table of {flow.dataflow_id} is not clustered yet: cluster_by needs a full refresh")
            counted: dict[tuple[str, int], int] = {}
            ranges = ClusterRanges(ws.spark, f"{path}_ranges", flow.cluster_by)
            for query in append_flow_streams(rows, path, checkpoint, ranges, counted):
                query.awaitTermination()
            run.rows = sum(counted.values())
            return
        with WrittenRows(ws.spark) as written:
            if flow.append_flows:
                queries = append_flow_streams({name: observed(s) for name, s in rows.items()}, path, checkpoint)
            else:
                queries = [bronze_stream(raw, flow, path, checkpoint, as_of)]
            for query in queries:
                query.awaitTermination()
            counts = [written.of(query) for query in queries]
            run.rows = None if None in counts else sum(counts)


def _appended(ws: Workspace, flow: BronzeFlow, given: Mapping[str, Any]) -> DataFrame:
    """A further source of a bronze table as a stream, in the columns of its contract if it has one."""
    fmt = file_format(given.get("format") or "parquet")
    schema = read_merged(ws.spark, given["source"], fmt).schema
    rows = read_source(ws.spark, given["source"], fmt, given.get("reader_options"), schema, stream=True)
    contract = flow.append_schemas.get(given["name"])
    return conform(rows, contract) if contract else rows


def run_silver(
    ws: Workspace, flow: SilverFlow, result: RunResult, group: str = "", refresh: bool = False,
    as_of: dt.datetime | None = None,
) -> None:
    if refresh:
        ws.next_generation(flow.dataflow_id, "silver")
    with _stage(ws, flow.dataflow_id, group, "silver", result) as run:
        source = f"{ws.path(flow.source)}/g{ws.generation(flow.dataflow_id, 'bronze')}"
        schema = read_merged(ws.spark, source).schema
        rows = read_source(ws.spark, source, schema=schema, stream=True).drop(FLOW, BATCH)
        target = ws.silver_target(flow)
        def store(counts: list[dict], place: str) -> None:
            """The event of a batch, in a folder of its own, so that one that comes again replaces it."""
            if counts:
                seen = ws.spark.createDataFrame(counts, "rule string, action string, passed bigint, failed bigint, total bigint")
                log = event_log(seen, flow.dataflow_id, moment(as_of))
                log.coalesce(1).write.mode("overwrite").parquet(f"{ws.metadata('event_log', flow.dataflow_id)}/{place}")

        batches = SilverBatches(flow, target, ws.quarantine_path(flow), as_of, store)
        silver_stream(rows, batches, ws.checkpoint(flow, "silver")).awaitTermination()
        batches.finish()
        if isinstance(target, ChangeTarget) and target.pending_batches() >= ws.compact_every:
            target.compact()
        run.rows = batches.rows
        result.quality = list(batches.metrics.values())
        if isinstance(target, LatestRows):  # counts of a batch are differences here; the run has the whole
            store(result.quality, f"{SOURCE}={run.execution_id}/{BATCH}=0")


def reprocess_quarantine(
    ws: Workspace, flow: SilverFlow, corrections: Mapping[str, str], batch_id: int
) -> QualityResult | None:
    """Correct the quarantined rows of a silver flow with SQL expressions and apply those that pass its rules now.

    Corrected rows keep their sequence, so a later change of the same key still wins, and doing this twice changes
    nothing. The quarantine itself stays as a record. Returns the split rows, None without a quarantine.
    """
    held = open_table(ws.spark, ws.quarantine_path(flow), mergeSchema="true")
    if held is None:
        return None
    result = reprocess(held.drop(SOURCE, BATCH), corrections, flow.rules)
    raise_offenders(row.asDict() for row in result.metrics.collect())
    target = ws.silver_target(flow)
    if isinstance(target, LatestRows):
        raise ValueError("a deduplicated table takes corrections through its source only")
    if isinstance(target, ChangeTarget):
        target.append(result.kept, batch_id, "reprocessed")
    else:
        result.kept.write.mode("overwrite").parquet(f"{target}/{SOURCE}=reprocessed/{BATCH}={batch_id}")
    return result


def _stage(ws: Workspace, dataflow_id: str, group: str, stage: str, result: RunResult) -> StageRun:
    late = f"{ws.metadata('history_days')}/late"
    run = _RecordedStage(ws.spark, ws.metadata("pipeline_execution_history", dataflow_id), dataflow_id, stage, group or "", late_path=late)
    run.result = result
    result.executions[stage] = run.execution_id
    return run


class _RecordedStage(StageRun):
    result: RunResult

    def __exit__(self, kind, error, trace) -> bool:
        if error is None:
            self.result.rows[self.stage] = self.rows  # None: not known
        return super().__exit__(kind, error, trace)


def layer_checks(ws: Workspace, spec: Row, bronze_flow: BronzeFlow, silver_flow: SilverFlow) -> dict[str, TableChecks]:
    """The checks of each layer: load columns on raw, keys on silver, rows on all."""
    keys = tuple(silver_flow.changes.keys) if silver_flow.changes else ()
    return {
        "raw_bronze": TableChecks(
            ws.raw_table(spec), required=tuple(spec["raw_bronze"]["metadata_columns"] or ())
        ),
        "bronze": TableChecks(ws.table(bronze_flow, "bronze")),
        "silver": TableChecks(ws.table(silver_flow, "silver"), not_null=keys, unique=keys),
    }


VALIDATION = "table string, check string, status string, message string"


def run_validation(ws: Workspace, spec: Row, bronze_flow: BronzeFlow, silver_flow: SilverFlow, result: RunResult) -> None:
    """The checks of all layers as a stage of its own: carried out once, stored, and recorded like any stage.

    Checks that fail do not stop the run; they are in the result, which has one row per check of the spec.
    """
    with _stage(ws, spec["dataflow_id"], spec["dataflow_group"], "validate", result) as run:
        rows = validate(ws.spark, layer_checks(ws, spec, bronze_flow, silver_flow)).collect()
        result.validation = ws.spark.createDataFrame(rows, VALIDATION)
        result.failed_checks = sum(r["status"] == "FAILED" for r in rows)
        stored = result.validation.select(F.lit(run.execution_id).alias("execution_id"), "*")
        stored.coalesce(1).write.mode("append").parquet(ws.metadata("validation_results", spec["dataflow_id"]))
        run.metadata["failed_checks"] = str(result.failed_checks)
        run.rows = len(rows)


def record_metadata(ws: Workspace, dataflow_id: str, specs: DataFrame, execution_id: str, author: str = "oreflow") -> None:
    """Append the lineage edges that are new or changed, and a metadata version where the metadata differs from the
    active one."""
    found = {
        "data_lineage": (lineage_edges(specs, execution_id), new_lineage),
        "metadata_versions": (metadata_versions(specs, author), new_versions),
    }
    for name, (rows, new) in found.items():
        path = ws.metadata(name, dataflow_id)
        rows = new(rows, open_table(ws.spark, path))
        if not rows.isEmpty():
            rows.write.mode("append").parquet(path)


@dataclass(frozen=True)
class MonitoringRun:
    run_id: str
    alerts: DataFrame
    payloads: DataFrame
    status: DataFrame


def run_monitoring(
    spark: SparkSession, root: str, as_of: dt.datetime | None = None, t: Thresholds = Thresholds(), level: str = "all"
) -> MonitoringRun:
    """Check the run history of a workspace and append the outcome to the monitoring history.

    The alerts of this run are stored first, so that nothing below computes the checks again. The level limits the
    payloads only; history and status count all alerts.
    """
    ws = Workspace(spark, root)
    history = ws.read_metadata("pipeline_execution_history")
    if history is None:
        raise ValueError(f"no run history below {root}")
    run_id = uuid.uuid4().hex
    folded = FoldedHistory(spark, ws.metadata("history_days"))
    folded.fold(history, as_of)
    found = run_checks(history, f"{ws.metadata('alerts')}/run={run_id}", as_of, t, folded=folded)
    at = as_of or dt.datetime.now(dt.timezone.utc)
    rows = monitoring_history(found, run_id, at, t.window_hours)
    write_table(rows, ws.metadata("monitoring_history"), "append", ["monitoring_date"])
    write_table(monitoring_alerts(found, run_id, at), ws.metadata("monitoring_alerts"), "append", ["monitoring_date"])
    return MonitoringRun(run_id, found, chat_payloads(at_level(found, level)), monitoring_status(found, as_of))


def run_dataflow(
    spark: SparkSession, spec: Row, root: str, trigger_time: dt.datetime, full_refresh: bool = False,
    credentials: Mapping[str, str] | None = None, as_of: dt.datetime | None = None, **workspace,
) -> RunResult:
    """All stages of one dataflow, in order. A stage that fails is recorded, and the error is raised; the same run again
    skips the stages that were done (see ``StageLedger``), unless a full refresh asks for them anew.

    ``workspace`` takes the options of ``Workspace``.
    """
    ws, result = Workspace(spark, root, **workspace), RunResult(spec["dataflow_id"])
    specs = spark.createDataFrame([spec], SPEC_SCHEMA)
    bronze_flow = bronze_flow_of(bronze_specs(specs).first())
    silver_flow = silver_flow_of(silver_specs(specs).first())
    group = spec["dataflow_group"] or ""
    ledger = StageLedger(ws, result.dataflow_id, trigger_time)
    if full_refresh:  # of the raw rows, which a refresh does not fetch again, what is done stays done
        ledger.done = {k: v for k, v in ledger.done.items() if k == "rdb_ingestion"}
    ledger.run("rdb_ingestion", result, lambda: run_ingestion(ws, spec, trigger_time, result, credentials, ledger.stamp()))
    ledger.run("bronze", result, lambda: run_bronze(ws, bronze_flow, result, group, full_refresh, as_of))
    ledger.run("silver", result, lambda: run_silver(ws, silver_flow, result, group, full_refresh, as_of))
    record_metadata(ws, result.dataflow_id, specs, result.executions["silver"])
    run_validation(ws, spec, bronze_flow, silver_flow, result)
    ledger.close()
    return result


def run_dataflows(
    spark: SparkSession, specs: DataFrame, root: str, trigger_time: dt.datetime, parallel: int = 1, **options
) -> list[RunResult]:
    """Run several dataflows, ``parallel`` of them at a time. One that fails does not stop the others; the errors
    are raised together at the end."""
    results, errors = [], []
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        runs = [pool.submit(run_dataflow, spark, row, root, trigger_time, **options) for row in specs.collect()]
        for run in runs:
            try:
                results.append(run.result())
            except Exception as error:
                errors.append(error)
    if errors:
        raise ExceptionGroup("dataflows failed", errors)
    return results


def run_layer(
    spark: SparkSession, root: str, layer: str | None, group: str | None = None,
    bronze: DataFrame | None = None, silver: DataFrame | None = None, full_refresh: bool = False, **workspace,
) -> list[RunResult]:
    """Run the flows of a layer (bronze, silver or bronze_silver) from the spec tables, one group or all.

    Only the spec rows come to the driver; they are configuration.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {', '.join(LAYERS)}; got {layer!r}")
    ws, results = Workspace(spark, root, **workspace), {}
    tables = {"bronze": (bronze, bronze_flow_of, run_bronze), "silver": (silver, silver_flow_of, run_silver)}
    for name in LAYERS[layer]:
        specs, parse, run = tables[name]
        if specs is None:
            raise ValueError(f"layer {layer!r} needs the {name} spec table")
        rows = specs if group is None else specs.where(F.col("dataFlowGroup") == group)
        for row in rows.collect():
            result = results.setdefault(row["dataFlowId"], RunResult(row["dataFlowId"]))
            run(ws, parse(row), result, row["dataFlowGroup"], full_refresh)
    return list(results.values())
