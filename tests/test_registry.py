"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check import compare, database

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    """Same rows as the SQL, and no plan that gathers rows in one task or pairs them all."""
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, plan
    assert compare(spark, db, name, lambda *_: df, entry.oracle_sql().get(name), SF_DIR) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "doc_id" and df.count() > 0


@pytest.mark.parametrize(
    "name", ["merge_union", "assign_batches", "pagination_takewhile", "gated_hazards"]
)
def test_result_does_not_depend_on_partitions(spark, db, name, partitions="13"):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
