"""Every registered query against its SQL twin."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogue import quality, standins
from check_queries import compare, connect

SF = "/root/testdata/sf0.01"
ROWS_ONLY = {"rf_metrics"}
QUERIES = {k: v for k, v in entry.queries().items() if v.__module__.startswith("catalogue.")}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_only_iterative_queries_lack_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, verdict = compare(spark, con, SF, name, QUERIES[name], entry.oracle_sql().get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_extent_gaps_of_a_missing_row(spark, tmp_path):
    cells = standins.cells(spark, "/root/testdata/sf0.001").where("row = 1").select("cell_id")
    customers = standins.table(spark, "/root/testdata/sf0.001", "customer")
    customers.join(cells, customers["c_custkey"] == cells["cell_id"], "left_anti").write.parquet(f"{tmp_path}/customer.parquet")
    orders = standins.table(spark, "/root/testdata/sf0.001", "orders")
    orders.withColumn("o_custkey", F.lit(449)).write.parquet(f"{tmp_path}/orders.parquet")
    got = {tuple(r) for r in quality.qa_extent_gaps(spark, str(tmp_path)).collect()}
    assert {g for g in got if g[1] == 1} == {(k, 1, c) for k in ("customer", "absent") for c in range(50)}
    assert {(k, r) for k, r, _ in got if r >= 4} == {(k, r) for k in ("customer", "absent") for r in range(4, 9)}
    customers.limit(0).write.parquet(f"{tmp_path}/none/customer.parquet")
    orders.limit(0).write.parquet(f"{tmp_path}/none/orders.parquet")
    assert quality.qa_extent_gaps(spark, f"{tmp_path}/none").count() == 0
