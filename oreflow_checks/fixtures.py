"""Inputs that Spark derives from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.cdc import ChangeRules
from oreflow.operators.quality import Rule
from oreflow.plans.spec import SPEC_SCHEMA

AS_OF = "2024-01-31 00:00:00"
INGEST_AS_OF = "1998-06-15 12:00:00"

# Select list of the silver flow. ``changed_at`` is renamed first and recomputed from that alias at the end.
SILVER_SELECT = [
    "item_key", "src_key", "item_group", "price", "label", "changed_at AS changed_at_orig", "seq", "op",
    "captured_at", "ingest_dt", "source_system", "flow_id",
    "CASE WHEN op = 'D' THEN captured_at ELSE changed_at_orig END AS changed_at",
    "CASE WHEN op = 'D' THEN 'Y' ELSE 'N' END AS is_del",
]
VALID_CHANGE = "(op IN ('I', 'U') AND item_key IS NOT NULL) OR (op = 'D' AND item_key IS NULL)"
EXCEPT_COLUMNS = [
    "seq", "src_key", "op", "captured_at", "ingest_dt", "source_system", "flow_id", "changed_at_orig", "is_del",
]
RULES = ChangeRules(
    keys=["item_key"], key_fallback={"item_key": "src_key"}, sequence_by="seq", delete_when="is_del = 'Y'",
    except_columns=EXCEPT_COLUMNS,
)
EXPECTATIONS = [
    Rule("has_key", "op = 'D' OR item_key IS NOT NULL", "fail"),
    Rule("has_group", "op = 'D' OR item_group IS NOT NULL", "warn"),
    Rule("price_range", "price >= 0", "drop"),
    Rule("urgent_label", "label NOT LIKE '1-URGENT%' OR price < 400000", "quarantine"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_of(orders: DataFrame) -> DataFrame:
    """Orders as a change feed: one change per order, many changes per customer."""
    op = F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "P", "U").otherwise("D")
    deleted = F.col("o_orderstatus") == "F"
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("src_key"),
        op.alias("op"),
        F.when(~deleted, F.col("o_custkey")).alias("item_key"),
        F.when(~deleted & (F.col("o_orderkey") % 50 != 0), F.col("o_custkey") % 7 + 1).alias("item_group"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("price"),
        F.concat("o_orderpriority", F.lit("  ")).alias("label"),
        F.col("o_orderdate").alias("changed_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).alias("captured_at"),
        F.col("o_orderdate").alias("ingest_dt"),
        F.lit("shop_db").alias("source_system"),
        F.lit("items").alias("flow_id"),
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_of(table(spark, sf_dir, "orders"))


def silver_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(spark, sf_dir).selectExpr(*SILVER_SELECT).where(VALID_CHANGE)


def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.lit("item").alias("kind"),
        F.col("c_custkey").cast("string").alias("listed"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Yes").otherwise("No").alias("active"),
    )


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    third = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("execution_id"),
        F.concat(F.lit("df_"), (F.col("user_id") % 50).cast("string")).alias("dataflow_id"),
        F.concat(F.lit("grp_"), (F.col("user_id") % 5).cast("string")).alias("dataflow_group"),
        F.when(third == 0, "rdb_ingestion").when(third == 1, "bronze").otherwise("silver").alias("stage"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("MILLISECOND", F.round(F.col("value") * 10000).cast("long"), F.col("ts")).alias("end_time"),
        (F.col("value") * 10).alias("duration_seconds"),
        F.when(~failed, F.floor(F.col("value") * 100).cast("long")).alias("rows_processed"),
        F.when(failed, F.concat(F.lit("E:"), F.col("props"))).alias("error_message"),
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lineage row per user seen in the events."""
    flow = F.concat(F.lit("df_"), (F.col("user_id") % 50).cast("string"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("created_at")).select(
        F.col("user_id").cast("string").alias("lineage_id"), flow.alias("dataflow_id"),
        F.lit("shop_db").alias("source_system"),
        F.concat(F.lit("src."), F.col("user_id").cast("string")).alias("source_table"),
        F.concat(F.lit("lake."), F.col("user_id").cast("string")).alias("target_table"), "created_at",
    )


def _shaped(dtype: T.DataType, value: Any) -> Column:
    """A value in the shape of the spec schema: dicts fill structs, what they leave out is null."""
    if isinstance(value, dict):
        return F.struct(*[_shaped(f.dataType, value.get(f.name)).alias(f.name) for f in dtype.fields])
    return (value if isinstance(value, Column) else F.lit(value)).cast(dtype)


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested dataflow document per customer."""
    key = F.col("c_custkey")
    text, nation = key.cast("string"), F.col("c_nationkey").cast("string")

    def place(suffix: str) -> dict[str, Any]:
        return {"catalog": "base", "schema": "lake", "table": F.concat(F.lit("t"), text, F.lit(suffix))}

    def rule(name: str, constraint: str, action: str) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.lit(constraint).alias("constraint"), F.lit(action).alias("action")
        )

    rules = F.array_compact(F.array(
        rule("has_key", "item_key IS NOT NULL", "fail"),
        rule("has_group", "item_group IS NOT NULL", "warn"),
        F.when(key % 3 == 0, rule("price_range", "price >= 0", "drop")),
        F.when(key % 4 == 0, rule("label_set", "label <> ''", "QUARANTINE")),
        F.when(key % 7 == 0, rule("has_group", "item_group > 0", "warn")),
    ))
    by_key = F.array(F.lit("item_key"))
    document = {
        "dataflow_id": F.concat(F.lit("flow_"), text),
        "dataflow_group": F.concat(F.lit("grp_"), nation),
        "description": F.col("c_name"),
        "enabled": F.when(key % 5 == 0, False).when(key % 5 == 1, F.lit(None)).otherwise(True),
        "schedule": F.create_map(F.lit("cron"), F.lit("0 6 * * *"), F.lit("enabled"), F.lit("true")),
        "source": {
            "type": "files",
            "connection": F.create_map(
                F.lit("connection_name"), F.concat(F.lit("sys_"), nation),
                F.lit("jdbc_url"), F.concat(F.lit("jdbc:prod/"), text),
                F.lit("source_table"), F.concat(F.lit("src."), F.col("c_name")),
            ),
        },
        "raw_bronze": place("_raw"),
        "bronze": {**place("_bronze"), "cluster_by": by_key},
        "silver": {
            **place("_silver"),
            "transformations": {
                "select_expressions": F.array(F.lit("item_key"), F.lit("price")),
                "where_clauses": F.array(F.lit("item_key IS NOT NULL")),
            },
            "cdc_apply_changes": {
                "keys": by_key, "sequence_by": "seq", "scd_type": "1", "apply_as_deletes": "is_del = 'Y'",
                "except_column_list": F.array(F.lit("seq")),
            },
            "cluster_by": by_key,
            "data_quality": {"expectations": rules},
        },
    }
    return table(spark, sf_dir, "customer").select(
        *[_shaped(f.dataType, document.get(f.name)).alias(f.name) for f in SPEC_SCHEMA.fields]
    )
