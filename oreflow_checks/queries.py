"""One query per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow_checks import fixtures as fx
from oreflow.functions.clock import moment
from oreflow.functions.params import bind
from oreflow.functions.text import detail_lines
from oreflow.operators import cdc, joins, project, quality, validation
from oreflow.operators.dedup import latest_by
from oreflow.operators.filters import ingested_on, valid_change
from oreflow.plans import alerts as al
from oreflow.plans import flows, history, moments, monitor, reports, spec
from oreflow.plans.monitor import Thresholds
from oreflow.session import fresh_dir
from oreflow.sources.sinks import read_merged, write_table
from oreflow.sources.target import ChangeTarget, LatestRows
from oreflow.streaming.flows import append_flow_streams, apply_changes_stream, batch_stream, read_flows, stream_id

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NTZ = "timestamp_ntz"
DAY = Thresholds(window_hours=24)
TRIGGER = dt.datetime(1998, 6, 15, 12, 30, 15, 250000)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- change application -----------------------------------------------------------------------------------


@query
def scd1_apply_changes(spark, sf_dir):
    return cdc.apply_changes(fx.silver_input(spark, sf_dir), fx.RULES)


@query
def scd1_incremental(spark, sf_dir):
    """Four batches, applied out of order."""
    feed, state = fx.silver_input(spark, sf_dir), None
    for number in (2, 0, 3, 1):
        state = cdc.apply_changes_incremental(state, feed.where(F.col("seq") % 4 == number), fx.RULES)
    return cdc.live_rows(state, fx.RULES)


@query
def scd1_overlay(spark, sf_dir):
    """A small batch laid over a large stored state without shuffling the state."""
    feed = fx.silver_input(spark, sf_dir)
    target = ChangeTarget(spark, fresh_dir(spark, "scd1-overlay"), fx.RULES)
    target.append(feed.where(F.col("seq") % 50 != 7), 0)
    target.compact()
    target.append(feed.where(F.col("seq") % 50 == 7), 1)
    return target.current(small_batches=True)


@query
def scd1_stored(spark, sf_dir):
    """A stored target: batches appended, compacted, appended again."""
    feed = fx.silver_input(spark, sf_dir)
    target = ChangeTarget(spark, fresh_dir(spark, "scd1-stored"), fx.RULES)
    target.append(feed.where(F.col("seq") % 2 == 1), 0)
    target.compact()
    target.append(feed.where(F.col("seq") % 2 == 0), 1)
    return target.current()


@query
def scd1_bucketed(spark, sf_dir):
    """A stored target with a bucketed base: the second merge shuffles the new batch only."""
    feed = fx.silver_input(spark, sf_dir)
    target = ChangeTarget(spark, fresh_dir(spark, "scd1-bucketed"), fx.RULES, buckets=16)
    target.append(feed.where(F.col("seq") % 2 == 1), 0)
    target.compact()
    target.append(feed.where(F.col("seq") % 2 == 0), 1)
    return target.current()


@query
def scd1_stream(spark, sf_dir):
    # A pattern, because a stream takes a plain path for a folder and the table may be a single file.
    path = f"{sf_dir}/{{orders.parquet}}"
    orders = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    rows = fx.feed_of(orders).selectExpr(*fx.SILVER_SELECT).where(fx.VALID_CHANGE)
    root = fresh_dir(spark, "scd1-stream")
    target = ChangeTarget(spark, f"{root}/target", fx.RULES)
    apply_changes_stream(rows, target, f"{root}/checkpoint").awaitTermination()
    return target.current()


@query
def scd1_soft_delete(spark, sf_dir):
    """Deletes that carry their key and time only; the first half of the changes is a stored state."""
    rules = cdc.ChangeRules(
        keys=["item_key"], key_fallback={"item_key": "src_key"}, sequence_by="seq", delete_when="is_del = 'Y'",
        except_columns=fx.EXCEPT_COLUMNS, soft_delete=True, delete_columns=["changed_at"],
    )
    gone = F.col("is_del") == "Y"
    feed = fx.silver_input(spark, sf_dir)
    feed = feed.withColumns({c: F.when(~gone, F.col(c)) for c in ("item_group", "price", "label")})
    state = cdc.apply_changes_incremental(None, feed.where(F.col("seq") % 2 == 0), rules)
    return cdc.live_rows(cdc.apply_changes_incremental(state, feed.where(F.col("seq") % 2 == 1), rules), rules)


def _snapshots(spark, sf_dir):
    feed = fx.silver_input(spark, sf_dir)
    return cdc.apply_changes(feed.where(F.col("seq") % 4 < 2), fx.RULES), cdc.apply_changes(feed, fx.RULES)


@query
def change_feed_diff(spark, sf_dir):
    before, after = _snapshots(spark, sf_dir)
    return cdc.change_feed(before, after, ["item_key"]).withColumnRenamed(cdc.CHANGE_TYPE, "change_type")


@query
def merge_change_feed(spark, sf_dir):
    """What the second compaction of a stored target changed, as the merge itself has told it."""
    feed = fx.silver_input(spark, sf_dir)
    target = ChangeTarget(spark, fresh_dir(spark, "merge-feed"), fx.RULES, feed=True)
    target.append(feed.where(F.col("seq") % 4 < 2), 0)
    target.compact()
    target.append(feed.where(F.col("seq") % 4 >= 2), 1)
    target.compact()
    return target.change_feed().withColumnRenamed(cdc.CHANGE_TYPE, "change_type")


@query
def scd1_from_snapshot(spark, sf_dir):
    before, after = _snapshots(spark, sf_dir)
    rules = cdc.ChangeRules(keys=["item_key"], sequence_by="version")
    state = before.withColumns({cdc.SEQUENCE: F.lit(1).cast("long"), cdc.DELETED: F.lit(False)})
    return cdc.live_rows(cdc.apply_changes_from_snapshot(state, after, rules, version=2), rules)


# --- sources and transforms -------------------------------------------------------------------------------


@query
def ingest_incremental(spark, sf_dir):
    log = fx.change_feed(spark, sf_dir).select("seq", "src_key", "op", "captured_at")
    master = fx.table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 0).select(
        "c_custkey", "c_name", "c_mktsegment"
    )
    return flows.ingest(log, master, "src_key", "c_custkey", "captured_at", "1998-01-01 00:00:00")


@query
def param_query(spark, sf_dir):
    fx.table(spark, sf_dir, "orders").createOrReplaceTempView("orders_param")
    text = """
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders_param
        WHERE o_orderdate >= CAST('${start_date}' AS TIMESTAMP_NTZ)
          AND o_orderdate < CAST('${trigger_time - timedelta(days=1)}' AS TIMESTAMP_NTZ)
          AND o_orderstatus = '${status}'
          AND o_orderpriority LIKE '${priority}%'
    """
    parameters = {
        "start_date": {"type": "date", "default": "1990-01-01", "runtime_value": "${trigger_time - timedelta(days=30)}"},
        "status": {"default": "O"},
        "priority": {"default": "2-"},
    }
    sql, args = bind(text, TRIGGER, parameters)
    return spark.sql(sql, args=args)


def _bronze_flow():
    return flows.BronzeFlow(
        source={}, target={},
        transformations=[
            {"type": "filter", "condition": (
                "item_key IN (SELECT CAST(listed AS BIGINT) FROM allowed_items WHERE kind = 'item' AND lower(active) = 'yes')"
            )},
            {"type": "add_column", "columns": {"bronze_at": "current_timestamp()"}},
        ],
    )


@query
def bronze_flow(spark, sf_dir):
    fx.allow_list(spark, sf_dir).createOrReplaceTempView("allowed_items")
    rows = flows.bronze(fx.change_feed(spark, sf_dir), _bronze_flow(), fx.AS_OF)
    return rows.withColumn("bronze_at", F.col("bronze_at").cast(NTZ))


SILVER_FLOW = flows.SilverFlow(
    source={}, target={}, select=fx.SILVER_SELECT, where=[fx.VALID_CHANGE], rtrim=True,
    rules=fx.EXPECTATIONS, changes=fx.RULES,
)


@query
def silver_flow(spark, sf_dir):
    return flows.silver(fx.change_feed(spark, sf_dir), SILVER_FLOW)


@query
def silver_select(spark, sf_dir):
    return fx.change_feed(spark, sf_dir).selectExpr(*fx.SILVER_SELECT)


@query
def add_metadata_columns(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    added = project.add_metadata_columns(
        rows,
        {
            # The forms of placeholders.
            "loaded_for": "${trigger_time.isoformat()}", "loaded_from": "${trigger_time - timedelta(days=1)}",
            "flow": "${dataflow_id}", "origin": "shop_db", "loaded_at": "current_timestamp()",
        },
        trigger_time=TRIGGER, context={"dataflow_id": "items"}, as_of=fx.AS_OF,
    )
    return added.withColumns({c: F.col(c).cast(NTZ) for c in ("loaded_from", "loaded_at")})


@query
def rtrim_strings(spark, sf_dir):
    return project.rtrim_strings(fx.change_feed(spark, sf_dir).select("seq", "label", "op"))


@query
def ingest_date_window(spark, sf_dir):
    return ingested_on(fx.change_feed(spark, sf_dir), "ingest_dt", fx.INGEST_AS_OF).select("seq", "op", "ingest_dt")


@query
def cdc_validity_filter(spark, sf_dir):
    """Feed rows joined to a master that lost some keys: their inserts and updates are no longer valid."""
    feed = fx.change_feed(spark, sf_dir)
    broken = feed.withColumn("item_key", F.when(F.col("src_key") % 10 != 0, F.col("item_key")))
    return broken.where(valid_change("op", "item_key")).select("seq", "src_key", "op", "item_key")


@query
def allowlist_semi_join(spark, sf_dir):
    allow = fx.allow_list(spark, sf_dir)
    rows = joins.semi_join_allowlist(
        fx.change_feed(spark, sf_dir), allow, "item_key", "listed", type_column="kind", type_value="item",
        use_column="active", use_value="yes",
    )
    return rows.select("seq", "item_key", "op")


@query
def dedup_row_number(spark, sf_dir):
    return latest_by(fx.change_feed(spark, sf_dir), ["src_key"], ["op", "seq DESC"]).select("src_key", "op", "seq")


@query
def dedup_second_row(spark, sf_dir):
    rows = latest_by(fx.change_feed(spark, sf_dir), ["src_key"], ["op", "seq DESC"], n=2)
    return rows.select("src_key", "op", "seq")


def _dedup_stream(spark, sf_dir, n):
    """The orders in eight batches that are cut across their keys and folded in between; larger orders, larger batches."""
    root = fresh_dir(spark, "dedup-stream")
    parts = fx.table(spark, sf_dir, "orders").withColumn("_part", F.col("o_orderkey") % 8)
    parts.write.partitionBy("_part").parquet(f"{root}/in")
    # Each task that writes has a file of every part, so files grow in number with the orders.
    files = len(spark.read.schema(parts.schema).parquet(f"{root}/in").inputFiles())
    stream = spark.readStream.schema(parts.schema).option("maxFilesPerTrigger", max(1, -(-files // 8))).parquet(f"{root}/in").drop("_part")
    dedup = flows.Deduplication(["src_key"], ["op", "seq DESC"], n)
    target = LatestRows(spark, f"{root}/latest", dedup.best, dedup.pick, fold_every=3)
    batch_stream(fx.feed_of(stream), lambda b, i: target.append(b, i, stream_id(b)), f"{root}/checkpoint").awaitTermination()
    return target.current().select(F.lit(n).alias("n"), "src_key", "op", "seq")


@query
def dedup_stream(spark, sf_dir):
    return _dedup_stream(spark, sf_dir, 1).unionByName(_dedup_stream(spark, sf_dir, 2))


def _gated(spark, sf_dir, fallback):
    """A flow whose key rule meets deletes without key and inserts and updates that have lost theirs."""
    feed = fx.change_feed(spark, sf_dir)
    feed = feed.withColumn("item_key", F.when(F.col("seq") % 11 != 0, F.col("item_key")))
    flow = flows.SilverFlow(
        source={}, target={}, select=fx.SILVER_SELECT, rules=[quality.Rule("has_key", "item_key IS NOT NULL", "quarantine")],
        changes=replace(fx.RULES, key_fallback={"item_key": "src_key"} if fallback else {}),
    )
    found = flows.silver_changes(feed, flow, gate=False)
    return [
        rows.select(F.lit(fallback).alias("fallback"), F.lit(what).alias("what"), "seq", "op", "item_key")
        for what, rows in (("applied", found.changes), ("held", found.quarantined))
    ]


@query
def silver_key_gate(spark, sf_dir):
    return joins.append_flows([*_gated(spark, sf_dir, True), *_gated(spark, sf_dir, False)])


# --- specs and metadata -----------------------------------------------------------------------------------


@query
def enabled_dataflows(spark, sf_dir):
    return spec.enabled_dataflows(fx.specs(spark, sf_dir)).select("dataflow_id", "dataflow_group")


ENVIRONMENT = {
    "catalog": "dev", "source": {"connection": {"jdbc_url": "jdbc:dev"}}, "schedule": {"enabled": False}
}


@query
def env_override(spark, sf_dir):
    moved = spec.override_environment(fx.specs(spark, sf_dir), ENVIRONMENT)
    return moved.select(
        "dataflow_id", F.col("raw_bronze.catalog").alias("raw_catalog"),
        F.col("bronze.catalog").alias("bronze_catalog"), F.col("silver.catalog").alias("silver_catalog"),
        F.col("source.connection")["jdbc_url"].alias("jdbc_url"),
        F.col("source.connection")["connection_name"].alias("connection_name"),
        F.col("schedule")["cron"].alias("schedule_cron"), F.col("schedule")["enabled"].alias("schedule_enabled"),
    )


@query
def spec_flatten(spark, sf_dir):
    documents = fx.specs(spark, sf_dir)
    silver = spec.silver_specs(documents, fx.AS_OF)
    bronze = spec.bronze_specs(documents, fx.AS_OF)
    return silver.select(
        "dataFlowId", "dataFlowGroup", F.lit("silver").alias("layer"),
        F.col("sourceDetails")["table"].alias("source_table"), F.col("targetDetails")["table"].alias("target_table"),
        F.array_join("selectExp", "|").alias("select_list"), F.array_join("whereClause", "|").alias("where_list"),
        F.get_json_object("cdcApplyChanges", "$.sequence_by").alias("sequence_by"),
        F.col("dataQualityExpectations").alias("expectations"),
        F.element_at("clusterBy", 1).alias("cluster_key"), "version", F.col("createDate").cast(NTZ).alias("created"),
    ).unionByName(bronze.select(
        "dataFlowId", "dataFlowGroup", F.lit("bronze").alias("layer"),
        F.col("sourceDetails")["source_table"].alias("source_table"),
        F.col("targetDetails")["table"].alias("target_table"),
        F.lit(None).cast("string").alias("select_list"), F.lit(None).cast("string").alias("where_list"),
        F.lit(None).cast("string").alias("sequence_by"), F.col("dataQualityExpectations").alias("expectations"),
        F.element_at("clusterBy", 1).alias("cluster_key"), "version", F.col("createDate").cast(NTZ).alias("created"),
    ))


@query
def spec_rules_by_action(spark, sf_dir):
    return spec.rule_counts(spec.silver_specs(fx.specs(spark, sf_dir)))


@query
def lineage_edges(spark, sf_dir):
    edges = history.lineage_edges(fx.specs(spark, sf_dir), "run_1", fx.AS_OF)
    return edges.select(
        "lineage_id", "dataflow_id", "source_system", "source_table", "target_table", "execution_id",
        F.col("created_at").cast(NTZ).alias("created_at"),
    )


def _versions(spark, sf_dir):
    content = F.concat(F.lit('{"price": '), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("}"))
    return fx.table(spark, sf_dir, "orders").select(
        F.sha2(F.concat(F.col("o_orderkey").cast("string"), content), 256).alias("version_id"),
        F.concat(F.lit("flow_"), F.col("o_custkey").cast("string")).alias("dataflow_id"),
        content.alias("metadata_content"), F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("boolean").alias("is_active"),
    )


@query
def metadata_active_version(spark, sf_dir):
    return history.with_active_flag(_versions(spark, sf_dir))


@query
def metadata_current_version(spark, sf_dir):
    return history.active_versions(_versions(spark, sf_dir)).select("dataflow_id", "version_id", "created_at")


@query
def metadata_rollback(spark, sf_dir):
    """The status of a customer's orders as the metadata of a dataflow: it changes, and changes back."""
    proposed = fx.table(spark, sf_dir, "orders").select(
        F.sha2(F.concat_ws(":", F.col("o_custkey").cast("string"), "o_orderstatus"), 256).alias("version_id"),
        F.concat(F.lit("flow_"), F.col("o_custkey").cast("string")).alias("dataflow_id"),
        F.col("o_orderstatus").alias("metadata_content"),
        F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("created_at"),
        F.lit(None).cast("boolean").alias("is_active"),
    )
    return history.with_active_flag(history.changed_versions(proposed))


# --- sinks ------------------------------------------------------------------------------------------------


def _by_status(spark, sf_dir, status):
    return fx.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)


@query
def append_schema_merge(spark, sf_dir):
    """Appends of which the later ones brought a new column."""
    path = fresh_dir(spark, "schema-merge")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    write_table(_by_status(spark, sf_dir, "O").select(*columns), path)
    write_table(_by_status(spark, sf_dir, "P").select(*columns, "o_orderpriority"), path)
    rest = fx.table(spark, sf_dir, "orders").where(~F.col("o_orderstatus").eqNullSafe("O") & ~F.col("o_orderstatus").eqNullSafe("P"))
    write_table(rest.select(*columns, "o_orderpriority", "o_orderdate"), path)
    return read_merged(spark, path).select(*columns, "o_orderpriority", "o_orderdate")


@query
def append_flows(spark, sf_dir):
    columns = ["o_orderkey", "o_orderstatus"]
    return joins.append_flows([
        _by_status(spark, sf_dir, "O").select(*columns),
        _by_status(spark, sf_dir, "P").select(*columns, "o_totalprice"),
        _by_status(spark, sf_dir, "F").select(*columns, "o_orderpriority"),
    ])


@query
def append_flows_contract(spark, sf_dir):
    """Streams of the orders by status, each with other columns and types, into one table under one contract."""
    root, columns = fresh_dir(spark, "flows"), ["o_orderkey", "o_totalprice", "o_orderpriority"]
    given = {
        "O": ["o_orderkey", "o_totalprice", "o_orderpriority"], "P": ["cast(o_orderkey as string) as o_orderkey", "o_totalprice"],
        "F": ["o_orderpriority", "cast(o_orderkey as decimal(20,0)) as o_orderkey"],
    }
    streams = {}
    for status, kept in given.items():
        rows = _by_status(spark, sf_dir, status).selectExpr(*kept)
        rows.write.parquet(f"{root}/in/{status}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/{status}")
        streams[status] = joins.conform(stream, "o_orderkey long, o_totalprice double, o_orderpriority string")
    for query_ in append_flow_streams(streams, f"{root}/table", f"{root}/checkpoints"):
        query_.awaitTermination()
    return read_flows(spark, f"{root}/table").select(*columns)


@query
def partitioned_roundtrip(spark, sf_dir):
    """A partitioned table of which one partition is then overwritten."""
    path = fresh_dir(spark, "partitioned")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, path, "overwrite", ["o_orderstatus"], balance=True)
    zeroed = orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(0.0))
    write_table(zeroed, path, "overwrite", ["o_orderstatus"], balance=True)
    return spark.read.schema(orders.schema).parquet(path)


# --- run history ------------------------------------------------------------------------------------------


@query
def run_history_row(spark, sf_dir):
    runs = fx.run_history(spark, sf_dir).drop("duration_seconds")
    rows = history.run_records(runs, F.create_map(F.lit("environment"), F.lit("dev")), fx.AS_OF)
    return rows.withColumns({
        "metadata": F.col("metadata")["environment"], "created_at": F.col("created_at").cast(NTZ),
    })


@query
def run_throughput(spark, sf_dir):
    return history.throughput(fx.run_history(spark, sf_dir))


@query
def latest_status(spark, sf_dir):
    return history.latest_status(fx.run_history(spark, sf_dir))


@query
def complete_dataflow(spark, sf_dir):
    """Three runs have recorded the same edges."""
    lineage = fx.lineage(spark, sf_dir)
    runs = [lineage.withColumn("updated_at", F.col("created_at") + F.expr(f"INTERVAL {n} DAYS")) for n in range(3)]
    return history.complete_dataflow(runs[0].unionByName(runs[2]).unionByName(runs[1]), fx.run_history(spark, sf_dir))


# --- data quality -----------------------------------------------------------------------------------------


def _checked(spark, sf_dir):
    return fx.change_feed(spark, sf_dir).select("seq", "op", "item_key", "item_group", "price", "label")


@query
def dq_metrics(spark, sf_dir):
    return quality.metrics(_checked(spark, sf_dir), fx.EXPECTATIONS)


@query
def dq_like_rule(spark, sf_dir):
    rules = [quality.Rule("label_form", "label LIKE '%-%'"), quality.Rule("label_high", "label LIKE '2-HIGH%'")]
    return quality.metrics(_checked(spark, sf_dir), rules)


@query
def dq_event_log(spark, sf_dir):
    log = quality.event_log(dq_metrics(spark, sf_dir), "items", moment(fx.AS_OF, NTZ))
    return quality.expectation_events(log)


@query
def dq_drop(spark, sf_dir):
    return _checked(spark, sf_dir).transform(quality.keep, [r for r in fx.EXPECTATIONS if r.action == "drop"])


@query
def dq_kept(spark, sf_dir):
    return quality.check(_checked(spark, sf_dir), fx.EXPECTATIONS, gate=False).kept


STRICT = [
    quality.Rule("has_group", "item_group IS NOT NULL", "quarantine"),
    quality.Rule("price_range", "price >= 0", "quarantine"),
]


def _quarantined(spark, sf_dir):
    return quality.check(_checked(spark, sf_dir), STRICT, gate=False).quarantined


@query
def dq_quarantine(spark, sf_dir):
    held = _quarantined(spark, sf_dir)
    return held.withColumn(quality.FAILED_RULES, F.array_join(quality.FAILED_RULES, ","))


@query
def dq_fail_gate(spark, sf_dir):
    rules = [quality.Rule("has_key", "item_key IS NOT NULL", "fail"), quality.Rule("seq_set", "seq IS NOT NULL", "fail")]
    return quality.violations(_checked(spark, sf_dir), rules)


@query
def dq_reprocess(spark, sf_dir):
    corrections = {"price": "abs(price)", "item_group": "CASE WHEN op = 'D' THEN NULL ELSE coalesce(item_group, 0) END"}
    again = quality.reprocess(_quarantined(spark, sf_dir), corrections, STRICT)
    return again.kept


@query
def violation_type_counts(spark, sf_dir):
    classes = [("item_key IS NULL", "key_null"), ("item_group IS NULL", "group_null")]
    labelled = project.classify(fx.change_feed(spark, sf_dir), classes, "normal", "violation_type")
    return labelled.groupBy("violation_type").agg(F.count(F.lit(1)).alias("rows"))


@query
def count_by_operation(spark, sf_dir):
    return fx.change_feed(spark, sf_dir).groupBy("op").agg(F.count(F.lit(1)).alias("rows"))


@query
def count_by_day(spark, sf_dir):
    days = fx.change_feed(spark, sf_dir).groupBy("ingest_dt").agg(F.count(F.lit(1)).alias("rows"))
    return days.orderBy(F.col("ingest_dt").desc())


# --- validation -------------------------------------------------------------------------------------------


@query
def val_record_count(spark, sf_dir):
    return validation.record_count(fx.table(spark, sf_dir, "orders"))


@query
def val_null_counts(spark, sf_dir):
    return validation.null_counts(fx.change_feed(spark, sf_dir), ["item_key", "item_group", "seq", "no_such_column"])


@query
def val_duplicates(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    by_customer = validation.duplicate_keys(orders, ["o_custkey"]).withColumn("key", F.lit("o_custkey"))
    return by_customer.unionByName(
        validation.duplicate_keys(orders, ["o_orderkey"]).withColumn("key", F.lit("o_orderkey"))
    )


def _layer_plan(spark, sf_dir):
    feed = fx.change_feed(spark, sf_dir)
    return {
        "raw_bronze": validation.TableChecks(feed, required=["ingest_dt", "source_system", "run_id"]),
        "bronze": validation.TableChecks(feed.where(F.col("op") != "D"), min_rows=10),
        "silver": validation.TableChecks(
            cdc.apply_changes(fx.silver_input(spark, sf_dir), fx.RULES), not_null=["item_key"], unique=["item_key"]
        ),
        "keyless": validation.TableChecks(feed, not_null=["item_key", "item_group"], unique=["item_key"]),
        "gold": validation.TableChecks(None),
    }


@query
def val_checks(spark, sf_dir):
    return validation.validate(spark, _layer_plan(spark, sf_dir))


@query
def val_touched(spark, sf_dir):
    """Counts of a table after each of four batches, of which each looks at its own keys only."""
    orders, part = fx.table(spark, sf_dir, "orders"), F.col("o_orderkey") % 4
    checks = validation.TableChecks(orders, not_null=["o_orderpriority"], unique=["o_custkey", "o_orderpriority"])
    added = [validation.touched_measure(orders.where(part < n), orders.where(part == n), checks) for n in range(4)]
    rows = [
        validation.added_measures(added[: n + 1]).select(
            F.lit(n).alias("batch"), F.col("_rows").alias("rows"), F.col("_null_0").alias("nulls"), F.col("_duplicates").alias("duplicates"))
        for n in range(4)
    ]
    return joins.append_flows(rows)


@query
def val_report(spark, sf_dir):
    results = validation.validate(spark, _layer_plan(spark, sf_dir))
    report = validation.validation_report(results, "items", fx.AS_OF)
    entry = "table string, check string, status string, message string"
    text = f"overall_status string, total_checks bigint, passed_checks bigint, failed_checks bigint, validations array<struct<{entry.replace(' ', ':').replace(',:', ', ')}>>"
    parsed = F.from_json("report_json", text)
    lines = F.transform(parsed["validations"], lambda v: F.concat_ws("|", v["table"], v["check"], v["status"], v["message"]))
    return report.withColumn("listed", F.array_join(lines, chr(10))).withColumn(
        "counted", F.concat_ws("/", parsed["overall_status"], parsed["total_checks"], parsed["passed_checks"], parsed["failed_checks"])
    ).drop("report_json")


# --- monitoring -------------------------------------------------------------------------------------------


@query
def mon_failures(spark, sf_dir):
    found = monitor.recent_failures(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)
    return found.orderBy(F.col("start_time").desc(), "execution_id")


@query
def mon_anomalies(spark, sf_dir):
    found = monitor.row_anomalies(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)
    return found.orderBy(F.abs("z_score").desc(), "dataflow_id", "stage")


@query
def mon_anomalies_sensitive(spark, sf_dir):
    """A lower threshold, and a baseline without the run under test."""
    t = Thresholds(window_hours=24, z=1.0, exclude_latest=True)
    return monitor.row_anomalies(fx.run_history(spark, sf_dir), fx.AS_OF, t)


@query
def mon_sla(spark, sf_dir):
    found = monitor.limit_breaches(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)
    return found.orderBy(F.col("duration_seconds").desc(), "execution_id")


@query
def mon_success_rate(spark, sf_dir):
    found = monitor.low_success_rates(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)
    return found.orderBy("success_rate_pct", "dataflow_id", "stage")


@query
def mon_freshness(spark, sf_dir):
    found = monitor.stale_pipelines(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)
    return found.orderBy(F.col("hours_since_last_run").desc(), "dataflow_id", "stage")


@query
def mon_freshness_by_frequency(spark, sf_dir):
    """Expected frequencies per dataflow replace the common limit for the dataflows that have one."""
    runs = fx.run_history(spark, sf_dir)
    expected = runs.groupBy("dataflow_id").agg(F.max("duration_seconds").alias("_longest")).where(
        F.col("_longest") < 2500
    ).select("dataflow_id", F.lit(36000).alias("expected_seconds"))
    return monitor.stale_pipelines(runs, fx.AS_OF, DAY, expected)


def _alerts(spark, sf_dir):
    return al.alerts(fx.run_history(spark, sf_dir), fx.AS_OF, DAY)


@query
def mon_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).withColumn("details", detail_lines(F.col("details")))


@query
def mon_alert_summary(spark, sf_dir):
    return al.alert_summary(_alerts(spark, sf_dir))


@query
def mon_level_filter(spark, sf_dir):
    return al.at_level(_alerts(spark, sf_dir), "critical").select("alert_type", "severity", "title")


@query
def mon_alert_payload(spark, sf_dir):
    return al.chat_payloads(_alerts(spark, sf_dir)).select("alert_type", "payload")


@query
def mon_alert_html(spark, sf_dir):
    return al.html_bodies(_alerts(spark, sf_dir)).select("alert_type", "html")


@query
def mon_history_row(spark, sf_dir):
    """The one row of a stored monitoring run."""
    stored = al.run_checks(fx.run_history(spark, sf_dir), fresh_dir(spark, "alerts"), fx.AS_OF, DAY)
    rows = al.monitoring_history(stored, "run_1", fx.AS_OF, 24)
    return rows.select(
        "run_id", "monitoring_date", "monitoring_window_hours", "alert_count", "critical_count", "warning_count", "alerts_json")


def _stored_history(spark, sf_dir):
    """The run history in folders by day, as the runner keeps it, its days folded up to some before the monitored ones."""
    root = fresh_dir(spark, "history")
    runs = fx.run_history(spark, sf_dir)
    runs.withColumn(history.RUN_DATE, F.to_date("start_time")).write.partitionBy(history.RUN_DATE).parquet(f"{root}/runs")
    stored = spark.read.parquet(f"{root}/runs")
    folded = moments.FoldedHistory(spark, f"{root}/days")
    folded.fold(stored, "2024-01-10 00:00:00")
    folded.fold(stored, "2024-01-30 00:00:00")
    return stored, folded


@query
def mon_alerts_folded(spark, sf_dir):
    """All checks from the runs of the last days and the moments of the days before them."""
    stored, folded = _stored_history(spark, sf_dir)
    found = al.run_checks(stored, fresh_dir(spark, "alerts"), fx.AS_OF, DAY, folded=folded)
    return found.withColumn("details", detail_lines(F.col("details")))


@query
def mon_day_moments(spark, sf_dir):
    """Moments of all runs, merged from those of the days."""
    merged = moments.merged_moments(moments.day_moments(fx.run_history(spark, sf_dir)))
    spread = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    return merged.select(
        "dataflow_id", "stage", "runs", "succeeded", "failed", "n", F.round("mean", 6).alias("mean"), F.round(spread, 6).alias("spread"), "last_success")


@query
def mon_alert_rows(spark, sf_dir):
    """The alerts of a monitoring run, one row each, read back from their JSON."""
    rows = al.monitoring_alerts(_alerts(spark, sf_dir), "run_1", fx.AS_OF)
    schema = "alert_type string, severity string, title string, message string, details map<string,string>, timestamp string"
    parsed = F.from_json("alert_json", schema)
    return rows.select(
        "run_id", "monitoring_date", "alert_type", "severity", parsed["title"].alias("title"), parsed["message"].alias("message"),
        detail_lines(parsed["details"]).alias("details"), parsed["timestamp"].alias("timestamp"),
        (parsed["alert_type"] == F.col("alert_type")).alias("same_type"))


@query
def dash_run_status(spark, sf_dir):
    """As of a moment inside the data: runs that started later are not seen."""
    rows = reports.run_status(fx.run_history(spark, sf_dir), "2024-01-20 12:00:00")
    return rows.withColumn("avg_duration", F.round("avg_duration", 4)).orderBy(
        F.col("last_run").desc(), "dataflow_id", "stage"
    )


@query
def recent_runs_top10(spark, sf_dir):
    return reports.recent_runs(fx.run_history(spark, sf_dir))


@query
def weekly_review(spark, sf_dir):
    return reports.weekly_review(fx.run_history(spark, sf_dir)).withColumn("avg_duration", F.round("avg_duration", 4))


@query
def sla_attainment(spark, sf_dir):
    return reports.sla_attainment(fx.run_history(spark, sf_dir))
