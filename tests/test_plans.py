"""Plan-shape guards for scale: pushdown reaches the scan, closure rounds read only key and
foreign-key columns, declared-key tables are emitted without a shuffle, and no registered
query plans a Cartesian product or a nested-loop join."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from graphloom.operators import closure as R
from graphloom.plans import tpch, tpch_queries as Q
from graphloom.plans.table_graph import instance_set
from tests.conftest import SF001


def plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_box_filter_pushed_to_scan(spark):
    text = plan(spark, E.queries()["root_in_box"](spark, SF001))
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in text
    assert "LessThanOrEqual(o_orderkey,1000000000000000)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_closure_round_reads_keys_only(spark):
    orders = tpch.table(spark, SF001, "orders")
    reach = R.Reach(spark, tpch.tables(spark, SF001, ["customer", "orders"]), tpch.mapping(spark, SF001))
    edges = reach.edges("orders", orders)
    ids = spark.createDataFrame([(1,)], "_key bigint")
    text = plan(spark, edges.join(ids, F.col("key") == F.col("_key"), "left_semi"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    # few keys are pushed to the scan
    text = plan(spark, reach.targets("orders", edges.where(F.col("key").isin([1, 5, 9]))))
    assert "In(o_orderkey, [1,5,9])" in text


def test_run_time_filter_reaches_the_scan(spark):
    """A large frontier filters the table by a Bloom filter on the bare key column."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
                "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        orders = tpch.table(spark, SF001, "orders")
        reach = R.Reach(spark, tpch.tables(spark, SF001, ["customer", "orders"]), tpch.mapping(spark, SF001))
        reach.frontier = orders.where("o_totalprice > 100000").select(F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("k"), F.lit(None).cast("string").alias("c"))
        text = plan(spark, reach._step("orders", None))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in text and "xxhash64(o_orderkey" in text


def test_declared_key_tables_emit_without_shuffle(spark):
    m = tpch.mapping(spark, SF001)
    frames = [(tpch.table(spark, SF001, t), m.table(t)) for t in ("orders", "customer")]
    text = plan(spark, instance_set(frames, Q.CFG))
    assert "Exchange" not in text and "HashAggregate" not in text
    li = [(tpch.table(spark, SF001, "lineitem"), m.table("lineitem"))]
    assert "HashAggregate" in plan(spark, instance_set(li, Q.CFG))  # derived key: deduplicated


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan(spark, Q.QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_staged_graph_predicate_filter_reaches_scan(spark):
    from graphloom.operators.sets import stage

    g = stage(Q.graph_of(spark, SF001, ["region"]))
    text = plan(spark, g.where(F.col("p") == "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"))
    assert "PushedFilters: [IsNotNull(p), EqualTo(p,http://www.w3.org/1999/02/22-rdf-syntax-ns#type)]" in text
