import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreflow.operators.filters import ingested_on, since, valid_change
from oreflow.operators.joins import append_flows, join_master, semi_join_allowlist
from oreflow.operators.project import add_metadata_columns, classify, rtrim_strings, select_where

NOON = dt.datetime(2024, 1, 31, 12, 0)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_alias_is_usable_later_in_the_list_and_in_where(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    result = select_where(df, ["t AS t0", "n * 10 AS m", "CASE WHEN m > 10 THEN 'x' ELSE t0 END AS t"], ["t = 'x'", "m = 20"])
    assert [tuple(r) for r in result.collect()] == [("b", 20, "x")]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_ingest_window_means_the_day_of_as_of(spark, kind):
    stamps = ["2024-01-30 23:59:59", "2024-01-31 00:00:00", "2024-01-31 18:30:00.5", "2024-02-01 00:00:00"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, at string").withColumn("at", F.col("at").cast(kind))
    assert column(ingested_on(df, "at", NOON), "i") == [1, 2]
    assert column(ingested_on(df, "at", NOON, days=2), "i") == [0, 1, 2]


def test_ingest_window_reads_iso_text(spark):
    df = spark.createDataFrame([("2024-01-31T09:00:00.123456",), ("2024-01-30T09:00:00",), ("no date",)], "at string")
    assert len(ingested_on(df, "at", NOON).collect()) == 1


def test_ingest_window_prunes_partitions(spark, tmp_path):
    days = spark.createDataFrame([(i, dt.date(2024, 1, 29 + i)) for i in range(3)], "i int, day date")
    days.write.partitionBy("day").parquet(f"{tmp_path}/days")
    plan = ingested_on(spark.read.parquet(f"{tmp_path}/days"), "day", NOON)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert ">= 2024-01-31" in filters and "<= 2024-01-31" in filters


def test_cursor_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, NOON), (2, NOON + dt.timedelta(days=1))], "i int, at timestamp").write.parquet(f"{tmp_path}/t")
    df = since(spark.read.parquet(f"{tmp_path}/t"), "at", "2024-02-01 00:00:00")
    assert column(df, "i") == [2]
    assert "GreaterThanOrEqual(at" in df._jdf.queryExecution().executedPlan().toString()


def test_change_validity(spark):
    rows = [("I", 1), ("U", None), ("D", None), ("D", 1), ("X", 1), (None, 1)]
    df = spark.createDataFrame(rows, "op string, k int")
    assert [tuple(r) for r in df.where(valid_change("op", "k")).collect()] == [("I", 1), ("D", None)]


def test_log_rows_survive_a_missing_master(spark):
    log = spark.createDataFrame([(1, 10), (2, 11), (1, 12)], "key int, seq int")
    master = spark.createDataFrame([(1, "a")], "id int, name string")
    found = {(r["key"], r["seq"], r["id"], r["name"]) for r in join_master(log, master, "key", "id").collect()}
    assert found == {(1, 10, 1, "a"), (1, 12, 1, "a"), (2, 11, None, None)}


def test_allowlist_keeps_rows_once_and_checks_use(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id bigint")
    allow = spark.createDataFrame(
        [("product_id", "1", "y"), ("product_id", "1", "Y"), ("product_id", "2", "N"), ("other", "3", "Y"), ("product_id", None, "Y")],
        "filter_type string, filter_value string, use_yn string",
    )
    used = semi_join_allowlist(df, allow, "id", "filter_value", "filter_type", "product_id", "use_yn")
    assert column(used, "id") == [1]
    assert sorted(column(semi_join_allowlist(df, allow, "id", "filter_value"), "id")) == [1, 2, 3]


def test_columns_that_log_and_master_share(spark, tmp_path):
    log = spark.createDataFrame([(1, "I"), (2, "D")], "key int, op string")
    joined = join_master(log, spark.createDataFrame([(1, "a")], "key int, name string"), "key", "key")
    joined.write.parquet(f"{tmp_path}/joined")
    assert {(r["S_key"], r["key"], r["name"]) for r in joined.collect()} == {(1, 1, "a"), (2, None, None)}
    with pytest.raises(ValueError, match="both have op"):
        join_master(log, spark.createDataFrame([(1, "x")], "id int, OP string"), "key", "id")


def test_metadata_columns(spark):
    result = add_metadata_columns(
        spark.range(1),
        {"a": "${trigger_time.isoformat()}", "b": "${trigger_time - timedelta(days=1)}", "c": "current_timestamp()",
         "d": "text", "e": 5, "f": "${execution_id}"},
        trigger_time=NOON, context={"execution_id": "run"}, as_of=NOON,
    ).first()
    assert (result["a"], result["d"], result["e"], result["f"]) == ("2024-01-31T12:00:00", "text", 5, "run")
    assert result["b"] == dt.datetime(2024, 1, 30, 12, 0) and result["c"] == NOON


def test_rtrim_touches_strings_only(spark):
    df = spark.createDataFrame([(" a  ", 1, ["x  "])], "s string, n int, l array<string>")
    assert tuple(rtrim_strings(df).first()) == (" a", 1, ["x  "])
    assert rtrim_strings(spark.range(1)).columns == ["id"]


def test_classify_takes_the_first_condition(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 1)], "a int, b int")
    assert column(classify(df, [("a IS NULL", "no a"), ("b IS NULL", "no b")], "fine", "c"), "c") == ["no a", "no b", "fine"]
    assert column(classify(df, [], "fine", "c"), "c") == ["fine"] * 3


def test_append_flows_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2.5, 2)], "d double, i int")
    assert [(r["i"], r["s"], r["d"]) for r in append_flows([a, b]).orderBy("i").collect()] == [(1, "x", None), (2, None, 2.5)]


def test_a_heavy_log_key_is_split(spark, tmp_path):
    """With a third of the log on one key, adaptive execution splits that partition and joins its parts apart."""
    log = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    log.write.parquet(f"{tmp_path}/log")
    spark.range(5000).withColumnRenamed("id", "k").withColumn("name", F.sha2(F.col("k").cast("string"), 256)).write.parquet(f"{tmp_path}/master")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = join_master(spark.read.parquet(f"{tmp_path}/log"), spark.read.parquet(f"{tmp_path}/master"), "key", "k")
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
