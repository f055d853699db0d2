"""Queries: check suites, monitoring, drift and streaming ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import differences, drift, quality, upsert
from tidemark.plans import feed
from tidemark.plans.cdc_queries import CLASS, CURRENT_ORDERS_SQL, EVENTS_SQL, empty_orders, order_changes
from tidemark.plans.registry import query
from tidemark.plans.shop import Shop, with_tables
from tidemark.session import Tables, scratch_path
from tidemark.sources import landing
from tidemark.streaming.pipelines import BronzeIngest, CurrentStateStream

NOW = "2002-01-01 00:00:00"


def at(text: str = NOW):
    return F.lit(text).cast("timestamp_ntz")


@query("quality_check_suite", """
WITH o AS (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS prio FROM orders),
p AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'orders_has_rows' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'row_count=' || count(*) AS details FROM o
UNION ALL SELECT 'orders_id_not_null', CASE WHEN count(*) = count(o_orderkey) THEN 'PASS' ELSE 'FAIL' END, 'null_id_count=' || (count(*) - count(o_orderkey)) FROM o
UNION ALL SELECT 'orders_id_unique', CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'PASS' ELSE 'FAIL' END,
  'row_count=' || count(*) || ', distinct_id_count=' || count(DISTINCT o_orderkey) FROM o
UNION ALL SELECT 'orders_priority_not_null', CASE WHEN count(*) = count(prio) THEN 'PASS' ELSE 'FAIL' END, 'null_priority_count=' || (count(*) - count(prio)) FROM o
UNION ALL SELECT 'orders_customer_fk', CASE WHEN count_if(p.c_custkey IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END,
  'missing_customer_ref_count=' || count_if(p.c_custkey IS NULL) FROM o LEFT JOIN p ON p.c_custkey = o.o_custkey""")
def quality_check_suite(t: Tables) -> DataFrame:
    """Five checks in one pass; the low priority is blanked and negative-balance customers left out."""
    orders = t.orders.withColumn("prio", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return quality.check_suite(
        orders, "orders", "o_orderkey", {"priority": "prio"},
        ("customer", "o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey"),
    )


@query("quality_duplicate_keys", """
SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 HAVING count(*) > 1 ORDER BY cnt DESC, user_id LIMIT 100""")
def quality_duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.events, ["user_id"])


@query("quality_range_check", """
SELECT 'price_range' AS check_name, count(*) FILTER (l_extendedprice < 1000 OR l_extendedprice > 90000) AS out_of_range_count, count(*) AS total_rows,
  min(l_extendedprice) AS min_amount, max(l_extendedprice) AS max_amount,
  CASE WHEN count_if(l_extendedprice < 1000 OR l_extendedprice > 90000) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem""")
def quality_range_check(t: Tables) -> DataFrame:
    return quality.range_check(t.lineitem, "price_range", "l_extendedprice", 1000, 90000)


@query("quality_null_rate", """
SELECT 'low_priority_rate' AS check_name, count(*) - count(prio) AS null_count, count(*) AS total_rows,
  round((count(*) - count(prio)) * 1.0::DOUBLE / count(*), 6) AS null_rate, CASE WHEN count(*) = count(prio) THEN 'PASS' ELSE 'WARN' END AS status
FROM (SELECT nullif(o_orderpriority, '5-LOW') AS prio FROM orders)""")
def quality_null_rate(t: Tables) -> DataFrame:
    rows = t.orders.select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio"))
    return quality.null_rate(rows, "low_priority_rate", "prio")


@query("quality_key_uniqueness", """
SELECT count(k) - count(DISTINCT k) AS duplicate_rows, count(*) - count(k) AS null_key_rows,
  CASE WHEN count(k) = count(DISTINCT k) THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)""")
def quality_key_uniqueness(t: Tables) -> DataFrame:
    rows = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return quality.key_uniqueness(rows, ["k"])


@query("quality_merge_gate", CURRENT_ORDERS_SQL)
def quality_merge_gate(t: Tables) -> DataFrame:
    """Merge, then gate on the key before the result is handed on."""
    path = scratch_path(t.spark, "gated")
    upsert.merge_changes(empty_orders(t), order_changes(t), ["order_id"]).write.parquet(path)
    merged = t.spark.read.parquet(path)
    quality.require_unique(merged, ["order_id"], "orders")
    return merged


@query("quality_result_log", """
SELECT 'run-1' AS run_id, 'silver' AS layer, 'lineitem' AS table_name, 'price_range' AS check_name,
  CASE WHEN count_if(l_extendedprice < 1000 OR l_extendedprice > 90000) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(count_if(l_extendedprice < 1000 OR l_extendedprice > 90000) AS DOUBLE) AS observed_value FROM lineitem""")
def quality_result_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dq-results")
    checks = quality.range_check(t.lineitem, "price_range", "l_extendedprice", 1000, 90000)
    quality.result_rows(checks, "run-1", "silver", "lineitem", at(), observed="out_of_range_count", threshold=0.0).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("run_id", "layer", "table_name", "check_name", "status", "observed_value")


@query("quality_volume_anomalies", """
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) FILTER (value >= 30 OR dayofweek(ts) <> 0) AS n FROM events GROUP BY 1, 2),
w AS (SELECT *, sum(CASE WHEN n > 0 THEN n END) OVER p AS s, count(CASE WHEN n > 0 THEN n END) OVER p AS k FROM c
  WINDOW p AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT event_type, CAST(day AS VARCHAR) AS day, n AS n_rows, CASE WHEN k > 0 THEN CAST(s AS DOUBLE) / k END AS rolling_average,
  CASE WHEN n = 0 THEN 'FAIL' WHEN k = 0 THEN 'PASS' WHEN n < CAST(s AS DOUBLE) / k * 0.5 THEN 'WARN' ELSE 'PASS' END AS status FROM w""")
def quality_volume_anomalies(t: Tables) -> DataFrame:
    """Daily event counts in which small values go missing on Sundays: the anomaly to find."""
    day = F.col("ts").cast("date")
    counted = (F.col("value") >= 30) | (F.dayofweek("ts") != 1)
    counts = t.events.groupBy("event_type", day.alias("day")).agg(F.count_if(counted).alias("n_rows"))
    return quality.volume_anomalies(counts, "event_type", "day", "n_rows")


def results(t: Tables) -> DataFrame:
    """A result log derived from orders: one check result per order."""
    return t.orders.select(
        F.concat(F.lit("run-"), F.date_format("o_orderdate", "yyyy-MM")).alias("run_id"),
        F.element_at(F.split("o_orderpriority", "-"), 2).alias("check_name"),
        F.when(F.col("o_totalprice") > 450000, "FAIL").when(F.col("o_totalprice") > 400000, "WARN").otherwise("PASS").alias("status"),
        F.col("o_orderstatus").alias("layer"), F.concat(F.lit("t"), F.year("o_orderdate")).alias("table_name"),
        F.col("o_totalprice").alias("observed_value"), F.col("o_orderdate").alias("checked_at"), "o_orderkey",
    )


RESULTS_SQL = """WITH r AS (SELECT 'run-' || strftime(o_orderdate, '%Y-%m') AS run_id, split_part(o_orderpriority, '-', 2) AS check_name,
  CASE WHEN o_totalprice > 450000 THEN 'FAIL' WHEN o_totalprice > 400000 THEN 'WARN' ELSE 'PASS' END AS status, o_orderstatus AS layer,
  't' || year(o_orderdate) AS table_name, o_totalprice AS observed_value, o_orderdate AS checked_at, o_orderkey FROM orders) """
LOG_NOW = "2000-07-01 00:00:00"


@query("quality_suite_status", RESULTS_SQL + """SELECT run_id, layer, count(*) AS n_checks, count(*) FILTER (status <> 'PASS') AS n_not_passed,
  CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM r GROUP BY 1, 2""")
def quality_suite_status(t: Tables) -> DataFrame:
    return quality.suite_status(results(t), ["run_id", "layer"])


@query("quality_recent_failures", RESULTS_SQL + f"""SELECT run_id, layer, table_name, check_name, status, observed_value, o_orderkey FROM r
WHERE status IN ('FAIL', 'WARN') AND checked_at >= TIMESTAMP '{LOG_NOW}' - INTERVAL 720 HOUR""")
def quality_recent_failures(t: Tables) -> DataFrame:
    return quality.recent_failures(results(t), at(LOG_NOW), hours=720).drop("checked_at")


@query("quality_failure_trend", RESULTS_SQL + f"""SELECT check_name, table_name, layer, count(*) AS failures FROM r
WHERE status = 'FAIL' AND checked_at >= TIMESTAMP '{LOG_NOW}' - INTERVAL 365 DAY GROUP BY 1, 2, 3""")
def quality_failure_trend(t: Tables) -> DataFrame:
    return quality.failure_trend(results(t), at(LOG_NOW), days=365)


@query("quality_pass_rate", RESULTS_SQL + f"""SELECT layer, CAST(CAST(checked_at AS DATE) AS VARCHAR) AS day, count(*) AS n_checks,
  CAST(count_if(status = 'PASS') AS DOUBLE) / count(*) AS pass_rate FROM r WHERE checked_at >= TIMESTAMP '{LOG_NOW}' - INTERVAL 30 DAY GROUP BY 1, 2""")
def quality_pass_rate(t: Tables) -> DataFrame:
    return quality.pass_rate(results(t), at(LOG_NOW))


@query("quality_volume_trend", "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows FROM events GROUP BY 1, 2")
def quality_volume_trend(t: Tables) -> DataFrame:
    return quality.volume_trend(t.events, "event_type", "ts")


@query("quality_quarantine_review", f"""
SELECT CASE WHEN c IN ('P1', 'P2') THEN 'null_or_empty_value' ELSE 'invalid_json' END AS quarantine_reason, 'orders' AS table_name, count(*) AS n,
  CAST(max(o_orderdate) AS VARCHAR) AS last_seen FROM (SELECT {CLASS} AS c, o_orderdate FROM orders)
WHERE c IN ('P1', 'P2', 'P3', 'P4') AND o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1""")
def quality_quarantine_review(t: Tables) -> DataFrame:
    """Quarantine times follow the event times, so the review window is testable."""
    from tidemark.sources.sinks import split_valid

    events = landing.normalise_landing(feed.faulty_landing(t))
    bad = split_valid(events, F.col("kafka_timestamp"))[1]
    return quality.quarantine_review(bad, F.lit("1999-01-01").cast("timestamp"))


@query("quality_duplicate_preview", """
SELECT user_id, event_type, event_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn > 1""")
def quality_duplicate_preview(t: Tables) -> DataFrame:
    return quality.duplicate_preview(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "rn"
    )


@query("quality_freshness", """
SELECT event_type, CAST(max(ts) AS VARCHAR) AS latest, date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-31 00:00:00')
   - CASE WHEN max(ts) > date_trunc('second', max(ts)) THEN 1 ELSE 0 END AS age_seconds,
  CASE WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 120 MINUTE THEN 'ERROR' WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 MINUTE THEN 'WARN'
  ELSE 'PASS' END AS status FROM events GROUP BY 1""")
def quality_freshness(t: Tables) -> DataFrame:
    return quality.freshness(t.events, "ts", at("2024-01-31 00:00:00"), by=["event_type"])


@query("quality_model_tests", """
SELECT 'c_custkey_not_null' AS check_name, CASE WHEN count_if(c_custkey IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count_if(c_custkey IS NULL) AS DOUBLE) AS observed_value FROM customer
UNION ALL SELECT 'c_nationkey_unique', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS DOUBLE) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'segment_accepted', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))
UNION ALL SELECT 'nation_relationship', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3))""")
def quality_model_tests(t: Tables) -> DataFrame:
    """Not null, unique, accepted values and relationship, rolled into log rows."""
    from tidemark.operators.assertions import tables, values

    c = t.customer
    outcomes = {
        "c_custkey_not_null": values.expect_column_values_to_not_be_null(c, "c_custkey"),
        "c_nationkey_unique": tables.expect_column_values_to_be_unique(c, "c_nationkey"),
        "segment_accepted": values.expect_column_values_to_be_in_set(c, "c_mktsegment", ["BUILDING", "MACHINERY"]),
        "nation_relationship": tables.relationships(c, "c_nationkey", t.nation.filter("n_regionkey < 3"), "n_nationkey"),
    }
    return quality.assertion_results(outcomes, "run-1", "silver", "customer", at()).select("check_name", "status", "observed_value")


@query("quality_reconcile_totals", with_tables("s_payment", """
SELECT rental_id, CAST(sum(amount) AS DOUBLE) AS right_total, CAST(sum(CASE WHEN flag = 'R' THEN amount ELSE amount - discount END) AS DOUBLE) AS left_total,
  CAST(sum(CASE WHEN flag = 'R' THEN 0 ELSE discount END) AS DOUBLE) AS discrepancy
FROM s_payment GROUP BY 1 HAVING abs(sum(CASE WHEN flag = 'R' THEN 0 ELSE discount END)) > 0.01"""))
def quality_reconcile_totals(t: Tables) -> DataFrame:
    """A mart whose unreturned payments lost their discount does not match its source."""
    payment = Shop(t).payment
    kept = F.when(F.col("flag") == "R", F.col("amount")).otherwise(F.col("amount") - F.col("discount"))
    gold = payment.groupBy("rental_id").agg(F.sum(kept).alias("total"))
    silver = payment.groupBy("rental_id").agg(F.sum("amount").alias("total"))
    return quality.reconcile(gold, silver, ["rental_id"], "total")


# A copy of the orders in which some prices, and the rows of one status and priority, differ.
COPY_SQL = """(SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 480000 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders
  WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))"""


def _copied(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    kept = t.orders.filter(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")))
    price = F.when(F.col("o_totalprice") > 480000, 0.0).otherwise(F.col("o_totalprice"))
    return orders, kept.select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"))


@query("quality_equality_by_digest", f"""
(SELECT *, 'a_minus_b' AS which_diff FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders EXCEPT SELECT * FROM {COPY_SQL}))
UNION ALL (SELECT *, 'b_minus_a' FROM (SELECT * FROM {COPY_SQL} EXCEPT SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders))""")
def quality_equality_by_digest(t: Tables) -> DataFrame:
    """Rows of one table only, looked for in the buckets whose digests differ."""
    return differences.equality_by_digest(*_copied(t))


@query("quality_reconcile_by_digest", f"""
SELECT o_orderkey, CAST(a.o_totalprice AS DOUBLE) AS left_total, CAST(b.o_totalprice AS DOUBLE) AS right_total,
  CAST(abs(coalesce(CAST(a.o_totalprice AS DECIMAL(18,2)), 0) - coalesce(CAST(b.o_totalprice AS DECIMAL(18,2)), 0)) AS DOUBLE) AS discrepancy
FROM orders a FULL JOIN {COPY_SQL} b USING (o_orderkey)
WHERE abs(coalesce(CAST(a.o_totalprice AS DECIMAL(18,2)), 0) - coalesce(CAST(b.o_totalprice AS DECIMAL(18,2)), 0)) > 0.01""")
def quality_reconcile_by_digest(t: Tables) -> DataFrame:
    """Keys whose measure differs, looked for in the buckets whose digests differ."""
    exact = [x.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")) for x in _copied(t)]
    return differences.reconcile_by_digest(*exact, ["o_orderkey"], "o_totalprice")


@query("quality_positive_amounts", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0""")
def quality_positive_amounts(t: Tables) -> DataFrame:
    from tidemark.operators.assertions.values import expression_is_true

    return expression_is_true(t.customer.select("c_custkey", "c_acctbal"), "> 0", "c_acctbal")


@query("quality_unique_grain", """
SELECT p_brand, p_type, count(*) AS n_records FROM part GROUP BY 1, 2 HAVING count(*) > 1""")
def quality_unique_grain(t: Tables) -> DataFrame:
    from tidemark.operators.assertions.tables import unique_combination_of_columns

    return unique_combination_of_columns(t.part, ["p_brand", "p_type"])


# The drifting feed's fields and types by the events that show them, from the orders and customer tables alone.
PROFILE_SQL = f"""
  WITH ev AS (SELECT *, op = 'c' AND o_orderpriority = '4-NOT SPECIFIED' AS cut FROM ({EVENTS_SQL})), found AS (
    SELECT 'orders' AS table_name, NULL AS field, 'unparsed' AS json_type FROM ev WHERE cut
    UNION ALL SELECT 'orders', 'order_id', 'number' FROM ev WHERE NOT cut
    UNION ALL SELECT 'orders', 'order_id', 'string' FROM ev WHERE op = 'u'
    UNION ALL SELECT 'orders', f, 'number' FROM ev, unnest(['customer_id', 'ordered_at']) u(f) WHERE NOT cut AND op <> 'd'
    UNION ALL SELECT 'orders', f, 'string' FROM ev, unnest(['status', 'priority', 'total']) u(f) WHERE NOT cut AND op <> 'd'
    UNION ALL SELECT 'customer', 'customer_id', 'number' FROM customer
    UNION ALL SELECT 'customer', 'name', 'string' FROM customer
    UNION ALL SELECT 'customer', 'balance', 'object' FROM customer)
  SELECT table_name, field, json_type, count(*) AS n_events FROM found GROUP BY ALL"""

FIELDS = [
    ("orders", "order_id", "number"), ("orders", "customer_id", "number"), ("orders", "status", "string"),
    ("orders", "priority", "number"), ("orders", "ordered_at", "number"), ("orders", "total", "string"),
    ("orders", "comment", "string"), ("customer", "customer_id", "number"), ("customer", "name", "string"),
]
CHANGES_SQL = f"""
  WITH p AS ({PROFILE_SQL}), k(table_name, field, contract_type) AS (VALUES {", ".join(map(str, FIELDS))}),
  seen AS (SELECT table_name, field, string_agg(json_type, ',' ORDER BY json_type) AS seen_type FROM p WHERE json_type <> 'unparsed' GROUP BY 1, 2)
  SELECT * FROM (
    SELECT table_name, field, contract_type, seen_type,
      CASE WHEN contract_type IS NULL THEN 'added' WHEN seen_type IS NULL THEN 'removed' WHEN seen_type <> contract_type THEN 'type_changed' END AS change
    FROM seen FULL JOIN k USING (table_name, field)) WHERE change IS NOT NULL
  UNION ALL SELECT DISTINCT table_name, NULL, NULL, NULL, 'unparsed' FROM p WHERE json_type = 'unparsed'"""
VERDICTS_SQL = f"""
  SELECT table_name, {", ".join(f"coalesce(string_agg(field, ',' ORDER BY field) FILTER (change = '{c}'), '') AS {n}" for c, n in (("added", "added_columns"), ("removed", "removed_columns"), ("type_changed", "type_changes")))},
    bool_or(change = 'unparsed') AS has_unparsed, CASE WHEN bool_or(change IN ('removed', 'type_changed')) THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
    NOT bool_or(change IN ('removed', 'type_changed')) AS is_valid FROM ({CHANGES_SQL}) GROUP BY 1"""


def _drift_profile(t: Tables) -> DataFrame:
    landed = feed.drifting_landing(t).unionByName(feed.customer_landing(t))
    images = [F.get_json_object("value", f"$.payload.{image}") for image in ("before", "after")]
    return drift.field_profile(landing.normalise_landing(landed, F.current_timestamp()), images, "table_name")


def _contract(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(FIELDS, "table_name string, field string, json_type string")


@query("drift_field_profile", PROFILE_SQL)
def drift_field_profile(t: Tables) -> DataFrame:
    """Both images of all events; repeated keys and events that can't be parsed are counted."""
    return _drift_profile(t)


@query("drift_classify", CHANGES_SQL)
def drift_classify(t: Tables) -> DataFrame:
    return drift.classify_drift(_drift_profile(t), _contract(t), "table_name")


@query("drift_policy", VERDICTS_SQL)
def drift_policy(t: Tables) -> DataFrame:
    changes = drift.classify_drift(_drift_profile(t), _contract(t), "table_name")
    return drift.drift_severity(changes, _contract(t), "table_name", policy="additive_only")


@query("drift_log", f"SELECT 'run-1' AS pipeline_run_id, 'orders_feed' AS source_system, table_name, severity FROM ({VERDICTS_SQL})")
def drift_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "drift-log")
    changes = drift.classify_drift(_drift_profile(t), _contract(t), "table_name")
    verdicts = drift.drift_severity(changes, _contract(t), "table_name", policy="permissive")
    drift.drift_log(verdicts, "table_name", "orders_feed", "run-1", at()).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("pipeline_run_id", "source_system", "table_name", "severity")


@query("stream_drain_to_bronze", f"""
WITH ev AS ({EVENTS_SQL}) SELECT 'orders' AS table_name, count(*) AS n_events, CAST(sum(o_orderkey * 4 + slot) AS BIGINT) AS offset_sum FROM ev""")
def stream_drain_to_bronze(t: Tables) -> DataFrame:
    """Run the ingest twice on one checkpoint: the second run finds nothing new."""
    bronze, bad, state, source = (scratch_path(t.spark, n) for n in ("bronze", "quarantine", "state", "landing"))
    feed.order_landing(t).repartition(6).write.json(source)
    job = BronzeIngest(bronze, bad)
    for _ in range(2):
        job.run(landing.normalise_landing(landing.landing_stream(t.spark, source, max_files_per_trigger=3)), state)
    return t.spark.read.parquet(bronze).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("offset").alias("offset_sum")
    )


def landed_files(t: Tables) -> int:
    """Files that a feed is landed in: some for each core, so that no task writes or reads a large share of it."""
    return 4 * t.spark.sparkContext.defaultParallelism


@query("stream_keyed_upsert", f"SELECT * EXCLUDE (last_inserted_dt) FROM ({CURRENT_ORDERS_SQL})")
def stream_keyed_upsert(t: Tables) -> DataFrame:
    """Micro-batches in landing order, late events among them, with a compaction halfway."""
    table, source, state = (scratch_path(t.spark, n) for n in ("silver", "landing", "state"))
    rows = feed.order_landing(t)
    job = CurrentStateStream(feed.ORDERS, table, empty_orders(t).schema)
    files = landed_files(t)
    for late in (True, False):
        rows.filter((F.col("offset") % 4 == 3) == late).repartition(files, "offset").write.mode("append").json(source)
        job.run(landing.normalise_landing(landing.landing_stream(t.spark, source, max_files_per_trigger=files // 2)), state)
        job.compact(t.spark)
    return job.read(t.spark).drop("event_ts_ms", "last_inserted_dt")


@query("stream_dedupe_and_gate", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""")
def stream_dedupe_and_gate(t: Tables) -> DataFrame:
    """The feed is landed twice over; in-batch dedupe and the key gate keep one row per order."""
    table, source = scratch_path(t.spark, "silver"), scratch_path(t.spark, "landing")
    doubled = feed.order_landing(t, landed_files(t) // 2)
    doubled.unionByName(doubled).write.option("compression", "gzip").json(source)
    job = CurrentStateStream(feed.ORDERS, table, empty_orders(t).schema)
    job.run(landing.normalise_landing(landing.landing_stream(t.spark, source)), scratch_path(t.spark, "state"))
    return job.read(t.spark).select("order_id", "status")


@query("stream_route_and_quarantine", f"""
SELECT CASE WHEN {CLASS} IN ('P1', 'P2') THEN 'null_or_empty_value' WHEN {CLASS} IN ('P3', 'P4') THEN 'invalid_json' ELSE 'orders' END AS destination,
  count(*) AS n_events FROM orders GROUP BY 1 UNION ALL SELECT 'customer', count(*) FROM customer""")
def stream_route_and_quarantine(t: Tables) -> DataFrame:
    bronze, bad, state, source = (scratch_path(t.spark, n) for n in ("bronze", "quarantine", "state", "landing"))
    feed.faulty_landing(t).unionByName(feed.customer_landing(t)).write.json(source)
    BronzeIngest(bronze, bad).run(landing.normalise_landing(landing.landing_stream(t.spark, source)), state)
    parts = [
        t.spark.read.parquet(bronze).select(F.col("table_name").alias("destination")),
        t.spark.read.parquet(bad).select(F.col("quarantine_reason").alias("destination")),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("destination").agg(F.count(F.lit(1)).alias("n_events"))
