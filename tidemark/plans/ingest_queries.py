"""Queries: gated ingest, deduplication across micro-batches, bucketed merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators import cdc, upsert
from tidemark.plans import feed
from tidemark.plans.cdc_queries import CURRENT_ORDERS_SQL, EVENTS_SQL, empty_orders
from tidemark.plans.registry import query
from tidemark.session import Tables, scratch_path, stored
from tidemark.sources import landing
from tidemark.sources.buckets import BucketedTable
from tidemark.streaming.dedupe import DedupedIngest
from tidemark.streaming.gated import GatedIngest

CONTRACT = (
    ("orders", "order_id", "number"), ("orders", "customer_id", "number"), ("orders", "status", "string"),
    ("orders", "priority", "string"), ("orders", "ordered_at", "number"), ("orders", "total", "string"),
    ("customer", "customer_id", "number"), ("customer", "name", "string"), ("customer", "balance", "object"),
)


def gated(t: Tables) -> GatedIngest:
    """Three runs over a growing landing folder, each a micro-batch.

    First all creations, of orders and customers; then updates that repeat a key under another type, with no customers;
    then the same updates as they should be, the customers again, and cut creations of one priority.
    """
    source, state = scratch_path(t.spark, "landing"), scratch_path(t.spark, "state")
    job = GatedIngest(scratch_path(t.spark, "gated"), CONTRACT, on_block="skip")
    landed = stored(feed.order_landing(t).withColumn("op", F.get_json_object("value", "$.payload.op")), "order-feed")
    creations, updates = (landed.filter(F.col("op") == op).drop("op") for op in ("c", "u"))
    repeated = F.replace(F.col("value"), F.lit('"order_id":'), F.lit('"order_id":"x","order_id":'))
    cut = creations.filter(F.col("value").contains('"priority":"4-NOT SPECIFIED"')).withColumn("value", F.substring("value", 1, 10))
    customers = feed.customer_landing(t)
    for rows in (creations.unionByName(customers), updates.withColumn("value", repeated), updates.unionByName(customers).unionByName(cut)):
        rows.write.mode("append").json(source)
        job.run(landing.normalise_landing(landing.landing_stream(t.spark, source)), state)
    return job


@query("stream_ingest_gated", f"""
WITH ev AS ({EVENTS_SQL})
SELECT CAST(CASE op WHEN 'c' THEN 0 ELSE 2 END AS BIGINT) AS batch, 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS message_key,
  o_orderkey * 4 + slot AS "offset", CAST(NULL AS VARCHAR) AS quarantine_reason, op FROM ev WHERE op IN ('c', 'u')
UNION ALL SELECT 2, 'orders', CAST(o_orderkey AS VARCHAR), o_orderkey * 4, 'invalid_json', NULL FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
UNION ALL SELECT b, 'customer', CAST(c_custkey AS VARCHAR), c_custkey, NULL, 'c' FROM customer, (VALUES (0), (2)) v(b)""")
def stream_ingest_gated(t: Tables) -> DataFrame:
    """Events and quarantine of the published batches; nothing of the batch whose schema drifted."""
    job = gated(t)
    visible = job.events(t.spark).unionByName(job.quarantine(t.spark), allowMissingColumns=True)
    return visible.select("batch", "table_name", "message_key", "offset", "quarantine_reason", F.get_json_object("value", "$.payload.op").alias("op"))


@query("stream_ingest_gate_log", f"""
WITH ev AS ({EVENTS_SQL}), n AS (SELECT count(*) FILTER (op = 'c') AS c, count(*) FILTER (op = 'u') AS u FROM ev),
k AS (SELECT count(*) AS k FROM customer), cut AS (SELECT count(*) AS cut FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'),
low AS (SELECT CASE WHEN u < c * 0.5 THEN 'WARN' ELSE 'PASS' END AS low FROM n)
SELECT 0::BIGINT AS batch, 'published' AS status, CAST(0 AS BIGINT) AS n_quarantined, 'orders' AS table_name, n.c AS n_rows, CAST(NULL AS DOUBLE) AS rolling_average,
  'PASS' AS volume_status, 'NONE' AS severity, '' AS type_changes FROM n
UNION ALL SELECT 0, 'published', 0, 'customer', k, NULL, 'PASS', 'NONE', '' FROM k
UNION ALL SELECT 1, 'blocked', 0, 'orders', u, c::DOUBLE, low, 'CRITICAL', 'order_id' FROM n, low
UNION ALL SELECT 1, 'blocked', 0, 'customer', 0, k::DOUBLE, 'FAIL', NULL, NULL FROM k
UNION ALL SELECT 2, 'published', cut, 'orders', u, c::DOUBLE, low, 'NONE', '' FROM n, low, cut
UNION ALL SELECT 2, 'published', cut, 'customer', k, k::DOUBLE, 'PASS', 'NONE', '' FROM k, cut""")
def stream_ingest_gate_log(t: Tables) -> DataFrame:
    """Every batch's state, and each source's volume and drift in it, the blocked batch's too."""
    job = gated(t)
    drifts = job.drift_log(t.spark).select("batch", "table_name", "severity", "type_changes")
    volumes = job.volume_log(t.spark).withColumnRenamed("status", "volume_status")
    return volumes.join(drifts, ["batch", "table_name"], "left").join(
        job.manifest(t.spark).select("batch", "status", "n_quarantined"), "batch")


# Redelivered events: what the second and third run bring again, and what is late then.
AGAIN_SQL = """
WITH first AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS mark FROM events WHERE ts < TIMESTAMP '2024-01-16'),
last AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS mark FROM events),
again AS (
  SELECT ts <= first.mark AS late FROM events, first WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-16'
  UNION ALL SELECT ts <= last.mark FROM events, last WHERE ts < TIMESTAMP '2024-01-03' OR ts >= TIMESTAMP '2024-01-28')"""


def deduped(t: Tables) -> DedupedIngest:
    """Three runs on one checkpoint; the second and third bring events again that earlier runs have had."""
    source, state = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "state")
    job = DedupedIngest(scratch_path(t.spark, "deduped"), ("event_id",), "ts", "3 days")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    day = lambda d: F.lit(f"2024-01-{d}").cast("timestamp")
    ts = F.col("ts")
    for arriving in (ts < day(16), ts >= day(12), (ts < day("03")) | (ts >= day(28))):
        rows.filter(arriving).write.mode("append").parquet(source)
        job.run(t.spark.readStream.schema(rows.schema).parquet(source), state)
    return job


@query("stream_dedupe_across_batches", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedupe_across_batches(t: Tables) -> DataFrame:
    """Every event once, though many arrive again in later batches."""
    return deduped(t).rows(t.spark).select("event_id", "user_id", "event_type", "value")


@query("stream_dedupe_log", AGAIN_SQL + """
SELECT (SELECT count(*) FROM events) AS n_output, count(*) FILTER (NOT late) AS n_duplicates, count(*) FILTER (late) AS n_late,
  (SELECT count(*) FROM events) + count(*) AS n_input, true AS bounded FROM again""")
def stream_dedupe_log(t: Tables) -> DataFrame:
    """Input, output, duplicates and late rows of all batches; the keys held at last are those of the watermark's time."""
    return deduped(t).log(t.spark).agg(
        *[F.sum(c).alias(c) for c in ("n_output", "n_duplicates", "n_late", "n_input")],
        (F.max_by("n_state_rows", "batch") < F.sum("n_output")).alias("bounded"))


@query("upsert_merge_buckets", f"SELECT * REPLACE (ordered_at AS last_inserted_dt) FROM ({CURRENT_ORDERS_SQL})")
def upsert_merge_buckets(t: Tables) -> DataFrame:
    """Creations, then updates, then deletes with the updates once more, each merged into the buckets they touch."""
    schema = T.StructType([*empty_orders(t).schema.fields, T.StructField("event_ts_ms", T.LongType())])
    table = BucketedTable(scratch_path(t.spark, "buckets"), ("order_id",), schema, buckets=16)
    table.load(t.spark.createDataFrame([], schema))
    changes = stored(cdc.decode_events(feed.order_events(t), feed.ORDERS), "changes")
    for ops in (["c"], ["u"], ["d", "u"]):
        latest = upsert.latest_per_key(changes.filter(F.col("op").isin(*ops)), ["order_id"], ["event_ts_ms", "bronze_offset"])
        table.merge(latest, order_column="event_ts_ms")
    return table.read(t.spark).drop("event_ts_ms")
