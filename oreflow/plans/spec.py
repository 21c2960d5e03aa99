"""Dataflow specs: one nested document per dataflow, as a DataFrame and as spec-table rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.clock import AsOf, moment
from oreflow.functions.schema import MapOf, struct
from oreflow.operators.quality import ACTION_KEYS

# Schema of one nested dataflow document.
SPEC_SCHEMA = struct({
    "dataflow_id": "string", "dataflow_group": "string", "description": "string", "enabled": "boolean",
    "schedule": MapOf(),
    "source": {
        "stage": "string", "type": "string", "connection": MapOf(),
        "extraction": {
            "prepare_query": "string", "main_query": "string", "read_options": MapOf(),
            "parameters": MapOf({"type": "string", "default": "string", "runtime_value": "string"}),
            "log": "string", "master": "string", "log_key": "string", "master_key": "string",
            "cursor_column": "string",
        },
    },
    "raw_bronze": {
        "catalog": "string", "schema": "string", "table": "string", "format": "string", "write_mode": "string",
        "partition_columns": ["string"], "table_properties": MapOf(), "metadata_columns": MapOf(),
    },
    "bronze": {
        "catalog": "string", "schema": "string", "table": "string", "table_comment": "string",
        "source_format": "string", "reader_options": MapOf(),
        "transformations": [{"type": "string", "condition": "string", "columns": MapOf()}],
        "table_properties": MapOf(), "cluster_by": ["string"],
        "append_flows": [{"name": "string", "source": "string", "format": "string", "reader_options": MapOf(), "schema": "string"}],
    },
    "silver": {
        "catalog": "string", "schema": "string", "table": "string", "table_comment": "string",
        "source_format": "string",
        "transformations": {
            "select_expressions": ["string"], "where_clauses": ["string"],
            "deduplication": {
                "enabled": "boolean", "partition_by": ["string"], "order_by": ["string"], "row_number": "int",
            },
        },
        "cdc_apply_changes": {
            "keys": ["string"], "key_fallback": MapOf(), "sequence_by": "string", "scd_type": "string",
            "apply_as_deletes": "string", "except_column_list": ["string"], "soft_delete": "boolean",
            "delete_columns": ["string"],
        },
        "string_transformations": {"rtrim": "boolean"},
        "table_properties": MapOf(), "cluster_by": ["string"],
        "data_quality": {"expectations": [{"name": "string", "constraint": "string", "action": "string"}]},
        "sinks": [{"name": "string", "path": "string", "format": "string", "options": MapOf()}],
    },
})

# Columns of the two spec tables. The last one holds what the others have no place for.
BRONZE_SPEC_COLUMNS = [
    "dataFlowId", "dataFlowGroup", "sourceFormat", "sourceDetails", "readerConfigOptions", "targetFormat",
    "targetDetails", "tableProperties", "schema", "partitionColumns", "cdcApplyChanges", "applyChangesFromSnapshot",
    "dataQualityExpectations", "quarantineTargetDetails", "quarantineTableProperties", "appendFlows",
    "appendFlowsSchemas", "clusterBy", "sinks", "version", "createDate", "createdBy", "updateDate", "updatedBy",
    "flowOptions",
]
SILVER_SPEC_COLUMNS = [
    "dataFlowId", "dataFlowGroup", "sourceFormat", "sourceDetails", "readerConfigOptions", "targetFormat",
    "targetDetails", "cdcApplyChanges", "tableProperties", "partitionColumns", "clusterBy", "selectExp",
    "whereClause", "applyChangesFromSnapshot", "quarantineTargetDetails", "quarantineTableProperties", "appendFlows",
    "appendFlowsSchemas", "sinks", "dataQualityExpectations", "version", "createDate", "createdBy", "updateDate",
    "updatedBy", "flowOptions",
]


def load_metadata(source: str | Path | Mapping[str, Any]) -> dict[str, Any]:
    """The metadata document from a dict, a JSON file or, when a YAML reader is installed, a YAML file."""
    if isinstance(source, Mapping):
        return dict(source)
    text = Path(source).read_text(encoding="utf-8")
    if str(source).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML metadata needs a YAML package; use JSON or a dict") from error
    return yaml.safe_load(text)


def _fit(value: Any, dtype: T.DataType) -> Any:
    """A document value in the shape of the schema; text is made of scalars where text is expected."""
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return {f.name: _fit(value.get(f.name), f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.MapType):
        return {str(k): _fit(v, dtype.valueType) for k, v in value.items()}
    if isinstance(dtype, T.ArrayType):
        return [_fit(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.StringType) and not isinstance(value, str):
        return json.dumps(value)
    return value


def specs_frame(spark: SparkSession, dataflows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Dataflow documents as rows of ``SPEC_SCHEMA``."""
    return spark.createDataFrame([_fit(d, SPEC_SCHEMA) for d in dataflows], SPEC_SCHEMA)


def load_specs(
    spark: SparkSession, source: str | Path | Mapping[str, Any], environment: str | None = None
) -> DataFrame:
    """Enabled dataflows of a metadata document, with the overrides of one environment."""
    metadata = load_metadata(source)
    specs = enabled_dataflows(specs_frame(spark, metadata.get("dataflows") or []))
    override = (metadata.get("environments") or {}).get(environment)
    return override_environment(specs, override) if override else specs


def enabled_dataflows(specs: DataFrame) -> DataFrame:
    """Dataflows that are not switched off; a missing flag means enabled."""
    return specs.where(F.coalesce(F.col("enabled"), F.lit(True)))


def _literal_map(values: Mapping[str, Any]) -> Column:
    pairs = [F.lit(x) for k, v in values.items() for x in (str(k), v if isinstance(v, str) else json.dumps(v))]
    return F.create_map(*pairs)


def overlay_map(base: Column, values: Mapping[str, Any]) -> Column:
    """``base`` with the given entries set; a null base counts as empty."""
    if not values:
        return base
    names = [str(k) for k in values]
    rest = F.map_filter(base, lambda k, _: ~k.isin(names))
    return F.coalesce(F.map_concat(rest, _literal_map(values)), _literal_map(values))


def override_environment(specs: DataFrame, override: Mapping[str, Any]) -> DataFrame:
    """Environment settings laid over every dataflow: catalog, source connection and schedule.

    The override is one small document, so it enters the plan as literals and needs no join.
    """
    columns: dict[str, Column] = {}
    if "catalog" in override:
        for stage in ("raw_bronze", "bronze", "silver"):
            moved = F.col(stage).withField("catalog", F.lit(override["catalog"]))
            columns[stage] = F.when(F.col(stage).isNotNull(), moved)
    connection = (override.get("source") or {}).get("connection")
    if connection:
        columns["source"] = F.col("source").withField(
            "connection", overlay_map(F.col("source.connection"), connection)
        )
    if "schedule" in override:
        columns["schedule"] = overlay_map(F.col("schedule"), override["schedule"])
    return specs.withColumns(columns) if columns else specs


def _as_json(value: Column) -> Column:
    return F.when(value.isNotNull(), F.to_json(value))


def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def _details(stage: str, comment: bool) -> Column:
    pairs = ["catalog", F.col(f"{stage}.catalog"), "database", F.col(f"{stage}.schema"),
             "table", F.col(f"{stage}.table")]
    if comment:
        pairs += ["comment", F.coalesce(F.col(f"{stage}.table_comment"), F.lit(""))]
    return F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in pairs])


def rules_by_action(expectations: Column) -> Column:
    """Rules of a spec row as one map per action: struct<expect, expect_or_fail, ...: map<name, constraint>>.

    Works inside the row, without exploding or grouping. Unknown actions count as warnings, the last of equal
    names wins, and actions without rules are null.
    """
    def action_of(rule: Column) -> Column:
        named = F.lower(rule["action"])
        return F.when(named.isin("fail", "drop", "quarantine"), named).otherwise("warn")

    def bucket(action: str) -> Column:
        mine = F.filter(expectations, lambda rule: action_of(rule) == action)

        def put(rules: Column, rule: Column) -> Column:
            name = F.coalesce(rule["name"], F.lit("unnamed"))
            others = F.map_filter(rules, lambda known, _: known != name)
            return F.map_concat(others, F.create_map(name, F.coalesce(rule["constraint"], F.lit("true"))))

        rules = F.aggregate(mine, _empty_map(), put)
        return F.when(F.exists(expectations, lambda rule: action_of(rule) == action), rules)

    return F.struct(*[bucket(action).alias(key) for action, key in ACTION_KEYS.items()])


def _audit(as_of: AsOf, author: str) -> dict[str, Column]:
    return {
        "version": F.lit("v1"), "createDate": moment(as_of), "createdBy": F.lit(author),
        "updateDate": moment(as_of), "updatedBy": F.lit(author),
    }


def _unused() -> dict[str, Column]:
    nothing = F.lit(None).cast("string")
    return {
        "partitionColumns": F.array().cast("array<string>"),
        "applyChangesFromSnapshot": nothing,
        "quarantineTargetDetails": _empty_map(),
        "quarantineTableProperties": _empty_map(),
        "appendFlows": nothing,
        "appendFlowsSchemas": _empty_map(),
        "sinks": nothing,
    }


def bronze_specs(specs: DataFrame, as_of: AsOf = None, author: str = "oreflow", fmt: str = "parquet") -> DataFrame:
    """Bronze spec rows. Filter and added columns travel in ``flowOptions``."""
    nothing = F.lit(None).cast("string")
    columns = {
        "dataFlowId": F.col("dataflow_id"),
        "dataFlowGroup": F.col("dataflow_group"),
        "sourceFormat": F.coalesce(F.col("bronze.source_format"), F.lit(fmt)),
        "sourceDetails": F.create_map(
            F.lit("source_catalog"), F.col("raw_bronze.catalog"), F.lit("source_database"),
            F.col("raw_bronze.schema"), F.lit("source_table"), F.col("raw_bronze.table"),
        ),
        "readerConfigOptions": F.coalesce(F.col("bronze.reader_options"), _empty_map()),
        "targetFormat": F.lit(fmt),
        "targetDetails": _details("bronze", comment=True),
        "tableProperties": F.coalesce(F.col("bronze.table_properties"), _empty_map()),
        "schema": nothing,
        "cdcApplyChanges": nothing,
        "dataQualityExpectations": nothing,
        "clusterBy": F.coalesce(F.col("bronze.cluster_by"), F.array().cast("array<string>")),
        "flowOptions": F.to_json(F.struct(F.col("bronze.transformations").alias("transformations"))),
        **_unused(), **_audit(as_of, author),
        "appendFlows": _as_json(F.transform("bronze.append_flows", lambda f: f.dropFields("schema"))),
        "appendFlowsSchemas": F.coalesce(F.map_from_entries(F.transform(
            F.filter("bronze.append_flows", lambda f: f["schema"].isNotNull()), lambda f: F.struct(f["name"], f["schema"]))), _empty_map()),
    }
    return specs.select(*[columns[name].alias(name) for name in BRONZE_SPEC_COLUMNS])


def silver_specs(specs: DataFrame, as_of: AsOf = None, author: str = "oreflow", fmt: str = "parquet") -> DataFrame:
    """Silver spec rows. Change rules and expectations are JSON text; deduplication and trimming travel in
    ``flowOptions``."""
    rules = rules_by_action(F.col("silver.data_quality.expectations"))
    has_rules = F.coalesce(F.size("silver.data_quality.expectations") > 0, F.lit(False))
    columns = {
        "dataFlowId": F.col("dataflow_id"),
        "dataFlowGroup": F.col("dataflow_group"),
        "sourceFormat": F.lit(fmt),
        "sourceDetails": _details("bronze", comment=False),
        "readerConfigOptions": _empty_map(),
        "targetFormat": F.lit(fmt),
        "targetDetails": _details("silver", comment=True),
        "cdcApplyChanges": _as_json(F.col("silver.cdc_apply_changes")),
        "tableProperties": F.coalesce(F.col("silver.table_properties"), _empty_map()),
        "clusterBy": F.coalesce(F.col("silver.cluster_by"), F.array().cast("array<string>")),
        "selectExp": F.coalesce(
            F.col("silver.transformations.select_expressions"), F.array().cast("array<string>")
        ),
        "whereClause": F.coalesce(F.col("silver.transformations.where_clauses"), F.array().cast("array<string>")),
        "dataQualityExpectations": F.when(has_rules, F.to_json(rules)),
        "flowOptions": F.to_json(F.struct(
            F.col("silver.transformations.deduplication").alias("deduplication"),
            F.col("silver.string_transformations.rtrim").alias("rtrim"),
        )),
        **_unused(), **_audit(as_of, author),
        "sinks": _as_json(F.col("silver.sinks")),
    }
    return specs.select(*[columns[name].alias(name) for name in SILVER_SPEC_COLUMNS])


def rule_counts(silver: DataFrame) -> DataFrame:
    """Rules per dataflow and action, read back from the JSON of the spec rows."""
    parsed = F.from_json(
        "dataQualityExpectations",
        T.StructType([T.StructField(k, T.MapType(T.StringType(), T.StringType())) for k in ACTION_KEYS.values()]),
    )
    # greatest() also turns the size of a missing map, null or -1 depending on the session, into 0.
    sizes = {key: F.greatest(F.size(F.col(f"_rules.{key}")), F.lit(0)) for key in ACTION_KEYS.values()}
    counted = silver.withColumn("_rules", parsed).select(
        "dataFlowId", *[size.alias(key) for key, size in sizes.items()]
    )
    return counted.withColumn("rule_count", sum((F.col(key) for key in sizes), F.lit(0)))
