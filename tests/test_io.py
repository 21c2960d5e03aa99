import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from oreflow import session
from oreflow.sources import readers, sinks


def test_schema_growth_on_append(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.write_table(spark.createDataFrame([(1, "a")], "i int, s string"), path) == 1
    assert sinks.write_table(spark.createDataFrame([(2, "b", 2.5), (3, "c", None)], "i int, s string, d double"), path) == 2
    merged = sinks.read_merged(spark, path).orderBy("i").collect()
    assert [(r["i"], r["s"], r["d"]) for r in merged] == [(1, "a", None), (2, "b", 2.5), (3, "c", None)]


def test_partitioned_overwrite_keeps_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = [dt.date(2024, 1, d) for d in (1, 2)]
    sinks.write_table(spark.createDataFrame([(1, day[0]), (2, day[1])], "i int, day date"), path, "overwrite", ["day"])
    sinks.write_table(spark.createDataFrame([(9, day[1])], "i int, day date"), path, "overwrite", ["day"], balance=True)
    sinks.write_table(spark.createDataFrame([(5, day[0])], "i int, day date"), path, "append", ["day"])
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == [1, 5, 9]
    sinks.write_table(spark.createDataFrame([(7,)], "other int"), path + "2", "overwrite")
    sinks.write_table(spark.createDataFrame([("x",)], "new string"), path + "2", "overwrite")
    assert spark.read.parquet(path + "2").columns == ["new"]


def test_clustered_files_hold_key_ranges(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_table(spark.range(1000).withColumn("k", (F.col("id") * 37) % 1000), path, cluster_by=["k"])
    ranges = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    edges = sorted((r["lo"], r["hi"]) for r in ranges.collect())
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


class TestClusterRanges:
    """Files of different batches of a clustered table line up."""

    def write(self, spark, path, batches, **options):
        ranges = sinks.ClusterRanges(spark, f"{path}_ranges", ["k", "id"], **options)
        for number, batch in enumerate(batches):
            sinks.write_table(ranges.arranged(batch, number), f"{path}/_batch={number}", "overwrite")
        return ranges

    def groups(self, path):
        """(batch, smallest key, largest key, rows) of every row group."""
        found = []
        for file in Path(path).rglob("*.parquet"):
            footer = pq.ParquetFile(file).metadata
            for i in range(footer.num_row_groups):
                group = footer.row_group(i)
                stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == "k")
                found.append((file.parent.name, stats.min, stats.max, group.num_rows))
        return found

    def keys(self, spark, n, key):
        return spark.range(n).select(key.alias("k"), "id").repartition(6)

    def test_a_key_filter_reads_few_row_groups_of_every_batch(self, spark, tmp_path):
        path = f"{tmp_path}/t"
        batches = [self.keys(spark, 20_000, F.hash("id", F.lit(i)) % 50_000) for i in range(3)]
        self.write(spark, path, batches, file_rows=500)
        groups = self.groups(path)
        assert sum(rows for *_, rows in groups) == 60_000
        for key in (-49_000, -7, 123, 31_000):
            for batch in range(3):
                mine = [g for g in groups if g[0] == f"_batch={batch}"]
                assert len(mine) > 30 and sum(low <= key <= high for _, low, high, _ in mine) <= 2
        # The bounds of the first batch part the others too.
        edges = sinks.ClusterRanges(spark, f"{path}_ranges", ["k"]).bounds()
        assert len(edges) <= 70

    def test_heavy_and_null_keys_and_keys_that_grow(self, spark, tmp_path):
        path, n = f"{tmp_path}/t", 12_000
        heavy = F.when(F.col("id") % 3 == 0, 3).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
        self.write(spark, path, [self.keys(spark, n, heavy), self.keys(spark, n, F.col("id") + 10**6)], file_rows=100)
        by_batch = {b: [rows for batch, *_, rows in self.groups(path) if batch == f"_batch={b}"] for b in (0, 1)}
        for sizes in by_batch.values():
            assert sum(sizes) == n and len(sizes) > 30 and max(sizes) < n / 12
        held = spark.read.parquet(path)
        assert held.where("k = 3").count() == held.where("k IS NULL").count() == n // 3

    def test_small_empty_and_repeated_batches(self, spark, tmp_path):
        path = f"{tmp_path}/t"
        small = spark.createDataFrame([(k, i) for i, k in enumerate(["b", None, "a", "b", "é", ""])], "k string, id int")
        ranges = self.write(spark, path, [small, small.limit(0), small])
        before = ranges.bounds()
        sinks.write_table(ranges.arranged(small, 2), f"{path}/_batch=2", "overwrite")
        assert ranges.bounds() == before
        held = sinks.read_merged(spark, path)
        assert held.count() == 12 and len([g for g in self.groups(path) if g[3]]) == 2
        nan = spark.createDataFrame([(float("nan"), 1), (None, 2), (1.0, 3)], "k double, id int")
        assert sinks.ClusterRanges(spark, f"{tmp_path}/nan", ["k"], file_rows=1).arranged(nan, 0).count() == 3


def test_a_heavy_partition_value_is_written_by_several_tasks(spark, tmp_path):
    plan = sinks.balanced(spark.range(10).withColumn("p", F.lit(1)), ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_several_sinks(spark, tmp_path):
    df = spark.range(5)
    sinks.write_all(df, f"{tmp_path}/a", [lambda d, p=p: d.write.parquet(f"{tmp_path}/{p}") for p in "bc"])
    assert [spark.read.parquet(f"{tmp_path}/{p}").count() for p in "abc"] == [5, 5, 5]


def test_open_table(spark, tmp_path):
    assert readers.open_table(spark, f"{tmp_path}/none") is None
    assert readers.open_table(spark, "no_such_table") is None
    spark.range(2).createOrReplaceTempView("two_rows")
    assert readers.open_table(spark, "two_rows").count() == 2
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert readers.open_table(spark, f"{tmp_path}/t").count() == 3
    assert readers.read_source(spark, f"{tmp_path}/t").count() == 3
    assert readers.read_source(spark, f"{tmp_path}/t", stream=True).isStreaming


def test_rows_typed_by_a_table(spark):
    table = spark.createDataFrame([], "i bigint, s string")
    assert readers.rows_like(spark, [(1, None)], table).schema == table.schema


class TestJdbcOptions:
    """The options of a JDBC scan. No database may be started here, so nothing is read."""

    BASE = {"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"}

    def test_query_becomes_a_subquery_and_is_split(self):
        options = readers.jdbc_options(
            **self.BASE, query="SELECT * FROM t;", partition_column="id", bounds=(1, 99), num_partitions=4
        )
        assert options == {
            "url": "jdbc:x", "user": "u", "password": "p", "driver": "d", "fetchsize": "1000",
            "dbtable": "(SELECT * FROM t) source_rows", "partitionColumn": "id", "lowerBound": "1", "upperBound": "99",
            "numPartitions": "4",
        }

    def test_prepare_statement_and_isolation(self):
        given = {**self.BASE, "table": "t", "prepare_query": "SELECT 1 INTO #x"}
        assert readers.jdbc_options(**given)["prepareQuery"] == "SELECT 1 INTO #x"
        isolated = readers.jdbc_options(**given, db_type="MSSQL")["prepareQuery"]
        assert isolated == "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED; SELECT 1 INTO #x"
        assert "prepareQuery" not in readers.jdbc_options(**self.BASE, table="t", db_type="mssql")

    def test_incomplete_requests_are_refused(self):
        with pytest.raises(ValueError):
            readers.jdbc_options(url="jdbc:x")
        with pytest.raises(ValueError):
            readers.jdbc_options(url="jdbc:x", query="q", table="t")
        with pytest.raises(ValueError):
            readers.jdbc_options(url="jdbc:x", table="t", partition_column="id")

    def test_scan_asks_for_bounds_first(self, spark, monkeypatch):
        asked = []
        monkeypatch.setattr(readers, "jdbc_bounds", lambda s, column, **source: asked.append(column) or (0, 9))
        seen = {}

        class Reader:
            def format(self, name):
                return self

            def options(self, **options):
                seen.update(options)
                return self

            def load(self):
                return "frame"

        class Session:
            read = Reader()

        assert readers.read_jdbc(Session(), partition_column="id", **self.BASE, table="t") == "frame"
        assert asked == ["id"] and (seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("0", "9", "8")


def test_shared_folder_comes_from_the_session():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" and self.value else default

    class Context:
        def __init__(self, master):
            self.master, self.applicationId = master, "app-1"

    class Session:
        def __init__(self, value, master):
            self.conf, self.sparkContext = Conf(value), Context(master)

    assert session.shared_root(Session("hdfs://x/shared/", "spark://m")) == "hdfs://x/shared"
    with pytest.raises(RuntimeError):
        session.shared_root(Session(None, "spark://m"))
    local = Session(None, "local[2]")
    assert session.shared_root(local) == session.shared_root(local)
    assert session.fresh_dir(local, "a") != session.fresh_dir(local, "a")
