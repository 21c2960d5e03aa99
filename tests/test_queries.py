"""Every registered query against its SQL counterpart on the test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from oreflow_checks.compare import difference, oracle_connection
from oreflow_checks.oracle import ORACLE
from oreflow_checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    assert difference(spark, oracle, name, SF_DIR) is None


def test_dedup_stream_has_no_more_batches_for_orders_in_more_files(spark, tmp_path, monkeypatch):
    """Every batch costs its own jobs, so their number must not follow that of the tasks that write the orders."""
    import oreflow.sources.target as target
    sizes = []
    append = target.LatestRows.append
    monkeypatch.setattr(target.LatestRows, "append", lambda self, rows, *place: (sizes.append(rows.count()), append(self, rows, *place)))
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    orders.repartition(5).write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["dedup_stream"](spark, str(tmp_path))
    want = QUERIES["dedup_row_number"](spark, SF_DIR)
    assert sorted(map(tuple, found.where("n = 1").drop("n").collect())) == sorted(map(tuple, want.collect()))
    assert 4 <= len(sizes) <= 16 and sum(sizes) == 2 * orders.count()
