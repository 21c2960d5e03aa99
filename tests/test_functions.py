import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions import bind, render, resolve, row_hash
from oreflow.functions.text import detail_lines, thousands, truncated

AT = dt.datetime(2024, 1, 31, 6, 30, 15, 123987)
PARAMETERS = {
    "start_date": {"type": "date", "default": "2020-01-01", "runtime_value": "${trigger_time - timedelta(days=1)}"},
    "region": {"default": "EU"},
}


def test_resolve_knows_a_closed_set():
    assert resolve("${trigger_time}", AT) == AT
    assert resolve("trigger_time - timedelta(hours=2)", AT) == AT - dt.timedelta(hours=2)
    assert resolve("${current_date()}", AT) == dt.date(2024, 1, 31)
    assert resolve("${dataflow_id}", AT, {"dataflow_id": "items"}) == "items"
    for text in ("__import__('os').getcwd()", "trigger_time.year", "1 + 1"):
        with pytest.raises(KeyError):
            resolve(text, AT)


def test_render_cuts_to_milliseconds():
    text = "x >= '${start_date}' AND t < '${trigger_time.isoformat()}' AND r = '${region}' AND d = '${current_date()}'"
    assert render(text, AT, PARAMETERS) == (
        "x >= '2024-01-30 06:30:15.123' AND t < '2024-01-31 06:30:15.123' AND r = 'EU' AND d = '2024-01-31'"
    )


def test_bind_passes_values_as_arguments(spark):
    sql, args = bind("SELECT '${region}' AS r, ${trigger_time} AS t", AT, {"region": {"default": "x'; --"}})
    row = spark.sql(sql, args=args).first()
    assert row["r"] == "x'; --"
    assert row["t"] == "2024-01-31 06:30:15.123"


def test_row_hash_ignores_map_order(spark):
    schema = T.StructType([T.StructField("m", T.MapType(T.StringType(), T.StringType()))])
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"b": "2", "a": "1"},)], schema)
    assert df.select(row_hash(df).alias("h")).distinct().count() == 1


def test_text_forms(spark):
    details = F.create_map(F.lit("A"), F.lit("1"), F.lit("B"), F.lit("<2>"))
    row = spark.range(1).select(
        thousands(F.lit(1234567)).alias("n"), thousands(F.lit(1234.5), 2).alias("d"),
        truncated(F.lit("x" * 300), 200, "none").alias("cut"), truncated(F.lit(""), 200, "none").alias("empty"),
        truncated(F.lit(None).cast("string"), 200, "none").alias("null"),
        detail_lines(details).alias("lines"),
    ).first()
    assert (row["n"], row["d"]) == ("1,234,567", "1,234.50")
    assert (len(row["cut"]), row["empty"], row["null"]) == (200, "none", "none")
    assert row["lines"] == "• *A*: 1\n• *B*: <2>"


def test_bind_inside_a_longer_literal(spark):
    values = {"p": {"default": "ab'c"}, "q": {"default": "z"}}
    sql, args = bind("SELECT 'x${p}y' AS a, 'k' LIKE '${q}%' AS no, 'zzz' LIKE '${q}%' AS yes, 'it''s ${q}' AS s, '${p}' AS p, '''${q}${q}''' AS t", AT, values)
    row = spark.sql(sql, args=args).first()
    assert (row["a"], row["no"], row["yes"], row["s"], row["p"], row["t"]) == ("xab'cy", False, True, "it's z", "ab'c", "'zz'")
