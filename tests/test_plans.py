"""What must reach the scan, and what must not appear in a plan."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import marts, reports, upsert, vault
from tidemark.plans import load_queries
from tidemark.plans.shop import Shop
from tidemark.session import Tables

PATH = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, PATH)


def test_watermark_is_pushed_to_the_scan(t):
    text = plan(vault.read_since(t.orders, F.lit("2000-01-01").cast("timestamp_ntz"), "o_orderdate").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_only_needed_columns_are_read(t):
    text = plan(marts.rental_mart(Shop(t).rental, Shop(t).payment).select("rental_id", "total_paid"))
    assert "l_tax" not in text and "l_returnflag" not in text and "o_totalprice" not in text


def test_merge_reads_only_target_columns_of_the_changes(t):
    target = t.customer.select("c_custkey", "c_name")
    changes = t.customer.withColumns({"op": F.lit("u"), "event_time": F.current_timestamp()})
    text = plan(upsert.merge_changes(target, changes, ["c_custkey"]))
    assert "c_acctbal" not in text and text.count("Exchange hashpartitioning") <= 2


def test_no_python_workers(t):
    for df in (marts.film_mart(Shop(t).film), upsert.latest_per_key(t.events, ["user_id"], ["ts", "event_id"])):
        assert "Python" not in plan(df)


def test_partitioned_writes_are_rebalanced(t):
    from tidemark.sources.sinks import balanced

    assert "REBALANCE_PARTITIONS_BY_COL" in plan(balanced(t.orders, ["o_orderstatus"]))


def test_rentals_shuffle_their_lines_once(spark):
    """The triples of an order and the order itself meet in the shuffle of the lines."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Shop(Tables(spark, PATH)).rental)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 2


def test_incremental_rental_mart_is_made_once(spark):
    """The stored part and the refreshing rows come from one making of the mart."""
    text = plan(load_queries()["mart_rental_incremental"].build(Tables(spark, PATH)))
    assert "lineitem.parquet" not in text and "rental-mart" in text


def test_grouped_text_reads_its_input_once(spark):
    df = spark.read.parquet(f"{PATH}/lineitem.parquet")
    text = plan(reports.grouped_text(df, ["l_orderkey"], F.col("l_partkey"), "t"))
    assert "lineitem.parquet" not in text and "grouped-text" in text
