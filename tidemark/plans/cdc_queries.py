"""Queries: sources and sinks, change decoding, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.decimals import Encoded, with_decimals
from tidemark.functions.payloads import extended_reason, quarantine_reason
from tidemark.operators import cdc, upsert
from tidemark.plans import feed
from tidemark.plans.registry import query
from tidemark.plans.shop import Shop
from tidemark.session import Tables, scratch_path
from tidemark.sources import landing, sinks
from tidemark.sources.contracts import LANDING

DELETED = "(o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"
LATE = "(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"

# One row per change event of the feed, from the orders table alone.
EVENTS_SQL = f"""
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, o_totalprice, e.op, e.days, e.slot, e.status
  FROM orders, LATERAL (
    SELECT 'c' AS op, 0 AS days, 0 AS slot, 'O' AS status
    UNION ALL SELECT 'u', 30, 1, o_orderstatus WHERE o_orderstatus <> 'O'
    UNION ALL SELECT 'd', 60, 2, NULL WHERE {DELETED}
    UNION ALL SELECT 'u', 10, 3, 'P' WHERE {LATE}
  ) e"""


def landed(t: Tables) -> str:
    """Write the order feed as landed JSON files and return their folder."""
    path = scratch_path(t.spark, "landing")
    feed.order_landing(t).write.mode("overwrite").json(path)
    return path


@query("source_landing_stream", f"""
WITH ev AS ({EVENTS_SQL})
SELECT 'cdc.public.orders' AS topic, CAST(o_orderkey AS VARCHAR) AS message_key,
  o_orderkey * 4 + slot AS "offset", epoch_ms(o_orderdate) + days * 86400000::BIGINT AS "timestamp" FROM ev""")
def source_landing_stream(t: Tables) -> DataFrame:
    out, state = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-state")
    stream = landing.landing_stream(t.spark, landed(t)).select("topic", "message_key", "offset", "timestamp")
    stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out)


@query("source_normalise_landing", f"""
WITH ev AS ({EVENTS_SQL})
SELECT 'public' AS source_schema, 'orders' AS table_name, o_orderkey * 4 + slot AS "offset",
  CAST(o_orderdate + INTERVAL 1 DAY * days AS VARCHAR) AS kafka_timestamp
FROM ev""")
def source_normalise_landing(t: Tables) -> DataFrame:
    feed_rows = feed.order_landing(t)
    stray = feed_rows.withColumn("topic", F.lit("heartbeat"))
    return landing.normalise_landing(feed_rows.unionByName(stray)).select(
        "source_schema", "table_name", "offset", "kafka_timestamp"
    )


@query("source_bronze_history", f"""
WITH ev AS ({EVENTS_SQL}) SELECT op, count(*) AS n_events FROM ev GROUP BY op""")
def source_bronze_history(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bronze")
    sinks.append_routed(feed.order_events(t), path)
    return landing.bronze_history(t.spark, path).groupBy(
        F.get_json_object("value", "$.payload.op").alias("op")
    ).agg(F.count(F.lit(1)).alias("n_events"))


@query("source_bronze_stream", f"""
WITH ev AS ({EVENTS_SQL}) SELECT op, count(*) AS n_events FROM ev GROUP BY op""")
def source_bronze_stream(t: Tables) -> DataFrame:
    path, out, state = (scratch_path(t.spark, n) for n in ("bronze", "stream-out", "stream-state"))
    sinks.append_routed(feed.order_events(t), path)
    schema = t.spark.read.parquet(path).schema
    ops = landing.bronze_stream(t.spark, path, schema).select(F.get_json_object("value", "$.payload.op").alias("op"))
    ops.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out).groupBy("op").agg(F.count(F.lit(1)).alias("n_events"))


@query("source_typed_values", """
SELECT event_id, user_id, event_type, value, CAST(date_trunc('second', ts) AS VARCHAR) AS bus_time FROM events""")
def source_typed_values(t: Tables) -> DataFrame:
    path, out, state = (scratch_path(t.spark, n) for n in ("bus", "stream-out", "stream-state"))
    t.events.select(
        (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).alias("timestamp"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"),
    ).write.parquet(path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double")
    stream = t.spark.readStream.schema("timestamp bigint, value string").parquet(path)
    typed = landing.typed_values(stream, schema).drop("ingested_at")
    typed.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out)


@query("source_stamped_json", f"""
WITH ev AS ({EVENTS_SQL}) SELECT 'orders_feed' AS source_system, true AS has_file, true AS has_time, count(*) AS n FROM ev""")
def source_stamped_json(t: Tables) -> DataFrame:
    rows = landing.stamped_json(t.spark, landed(t), LANDING, "orders_feed")
    return rows.groupBy(
        F.col("_source_system").alias("source_system"),
        F.col("_source_file").endswith(".json").alias("has_file"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("sink_route_by_table", f"""
WITH ev AS ({EVENTS_SQL})
SELECT 'orders' AS table_name, count(*) AS n_events FROM ev UNION ALL SELECT 'customer', count(*) FROM customer""")
def sink_route_by_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bronze")
    both = feed.order_landing(t).unionByName(feed.customer_landing(t))
    sinks.append_routed(landing.normalise_landing(both), path)
    return t.spark.read.parquet(path).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_events"))


CLASS = "o_orderstatus || substr(o_orderpriority, 1, 1)"


@query("sink_quarantine", f"""
SELECT CASE WHEN c IN ('P1', 'P2') THEN 'null_or_empty_value' WHEN c IN ('P3', 'P4') THEN 'invalid_json' ELSE 'kept' END AS outcome,
  count(*) AS n_events FROM (SELECT {CLASS} AS c FROM orders) GROUP BY 1""")
def sink_quarantine(t: Tables) -> DataFrame:
    good_path, bad_path = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "quarantine")
    events = landing.normalise_landing(feed.faulty_landing(t))
    good, bad = sinks.split_valid(events, F.current_timestamp())
    sinks.append_routed(good, good_path)
    sinks.append_rows(bad, bad_path)
    kept = t.spark.read.parquet(good_path).select(F.lit("kept").alias("outcome"))
    return kept.unionByName(t.spark.read.parquet(bad_path).select(F.col("quarantine_reason").alias("outcome"))).groupBy(
        "outcome"
    ).agg(F.count(F.lit(1)).alias("n_events"))


@query("sink_schema_evolution", """
SELECT o_orderstatus IS NOT NULL AND o_orderdate >= TIMESTAMP '1998-01-01' AS has_priority, count(*) AS n_rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def sink_schema_evolution(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evolving")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    sinks.append_rows(t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice"), path)
    sinks.append_rows(t.orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return landing.bronze_history(t.spark, path).groupBy(F.col("o_orderpriority").isNotNull().alias("has_priority")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )


@query("sink_snapshot_replace", """
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 2 ELSE 1 END AS load_no, count(*) AS n_rows
FROM orders GROUP BY 1, 2""")
def sink_snapshot_replace(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sliced")
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").cast("string").alias("month_start"), "o_orderdate")
    sinks.replace_slices(rows.withColumn("load_no", F.lit(1)), path, ["month_start"])
    later = rows.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).withColumn("load_no", F.lit(2))
    sinks.replace_slices(later, path, ["month_start"])
    sinks.replace_slices(later, path, ["month_start"])
    return t.spark.read.parquet(path).groupBy(F.col("month_start").cast("string").alias("month_start"), "load_no").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("sink_full_refresh", "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1")
def sink_full_refresh(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "refreshed")
    sinks.refresh_table(t.orders.filter("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey"), path)
    sinks.refresh_table(t.orders.select("o_orderstatus", "o_orderkey"), path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sink_predicate_overwrite", """
SELECT year(o_orderdate) AS order_year, CASE WHEN year(o_orderdate) >= 1999 THEN 'replaced' ELSE 'original' END AS version,
  count(*) AS n_rows FROM orders WHERE year(o_orderdate) < 1999 OR o_orderstatus = 'F' GROUP BY 1, 2""")
def sink_predicate_overwrite(t: Tables) -> DataFrame:
    """Years from 1999 on are replaced by their finished orders; earlier years stay."""
    path, following = scratch_path(t.spark, "yearly"), scratch_path(t.spark, "yearly")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("order_year"))
    sinks.replace_slices(rows.withColumn("version", F.lit("original")), path, ["order_year"])
    fresh = rows.filter("o_orderstatus = 'F'").withColumn("version", F.lit("replaced"))
    sinks.refresh_table(sinks.replace_where(t.spark.read.parquet(path), fresh, F.col("order_year") >= 1999), following)
    return t.spark.read.parquet(following).groupBy("order_year", "version").agg(F.count(F.lit(1)).alias("n_rows"))


@query("cdc_validate_envelope", f"""
SELECT o_orderkey AS order_id, CASE WHEN {CLASS} IN ('P1', 'P2') THEN 'null_or_empty_value'
  WHEN {CLASS} IN ('P3', 'P4') THEN 'invalid_json' ELSE 'ok' END AS reason FROM orders""")
def cdc_validate_envelope(t: Tables) -> DataFrame:
    return feed.faulty_landing(t).select(
        F.col("message_key").cast("bigint").alias("order_id"),
        F.coalesce(quarantine_reason(F.col("value")), F.lit("ok")).alias("reason"),
    )


@query("cdc_validate_extended", f"""
SELECT o_orderkey AS order_id, CASE WHEN {CLASS} IN ('P1', 'P2') THEN 'null_value'
  WHEN {CLASS} IN ('P3', 'P4') THEN 'json_parse_error' WHEN {CLASS} = 'F1' THEN 'invalid_op'
  WHEN {CLASS} = 'F2' THEN 'missing_source_table'
  WHEN o_orderdate < TIMESTAMP '1999-12-31' THEN 'stale_event' ELSE 'ok' END AS reason FROM orders""")
def cdc_validate_extended(t: Tables) -> DataFrame:
    return feed.faulty_landing(t).select(
        F.col("message_key").cast("bigint").alias("order_id"),
        F.coalesce(extended_reason(F.col("value"), F.lit("2000-01-01").cast("timestamp")), F.lit("ok")).alias("reason"),
    )


DECODED_SQL = f"""
WITH ev AS ({EVENTS_SQL})
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN op <> 'd' THEN CAST(o_custkey AS VARCHAR) END AS customer_id, status,
  CASE WHEN op <> 'd' THEN o_orderpriority END AS priority,
  CASE WHEN op <> 'd' THEN CAST(o_orderdate AS VARCHAR) END AS ordered_at,
  CASE WHEN op <> 'd' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total,
  op, CAST(o_orderdate + INTERVAL 1 DAY * days AS VARCHAR) AS event_time, o_orderkey * 4 + slot AS bronze_offset
FROM ev"""


@query("cdc_decode_events", DECODED_SQL)
def cdc_decode_events(t: Tables) -> DataFrame:
    return cdc.decode_events(feed.order_events(t), feed.ORDERS).select(
        "order_id", "customer_id", "status", "priority", "ordered_at", "total", "op", "event_time", "bronze_offset"
    )


@query("cdc_parse_envelope", f"""
WITH ev AS ({EVENTS_SQL})
SELECT o_orderkey * 4 + slot AS bronze_offset, op, epoch_ms(o_orderdate) + days * 86400000::BIGINT AS ts_ms,
  op <> 'c' AS has_before, op <> 'd' AS has_after FROM ev""")
def cdc_parse_envelope(t: Tables) -> DataFrame:
    return cdc.parse_envelopes(feed.order_events(t), feed.ORDERS.fields).select(
        "bronze_offset", "op", "ts_ms", F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after")
    )


@query("cdc_after_else_before", f"""
WITH ev AS ({EVENTS_SQL})
SELECT o_orderkey * 4 + slot AS bronze_offset, CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN op = 'u' THEN 'O' WHEN op = 'c' THEN 'O' END AS status_before_first FROM ev""")
def cdc_after_else_before(t: Tables) -> DataFrame:
    parsed = cdc.parse_envelopes(feed.order_events(t), feed.ORDERS.fields)
    return parsed.select(
        "bronze_offset",
        cdc.first_present(["after.order_id", "before.order_id"]).alias("order_id"),
        cdc.first_present(["before.status", "after.status"]).alias("status_before_first"),
    )


@query("cdc_json_paths", f"""
WITH ev AS ({EVENTS_SQL})
SELECT o_orderkey * 4 + slot AS bronze_offset, CAST(o_orderkey AS VARCHAR) AS order_id, 'orders' AS source_table FROM ev""")
def cdc_json_paths(t: Tables) -> DataFrame:
    return feed.order_events(t).select(
        F.col("offset").alias("bronze_offset"),
        cdc.first_json(["$.payload.after.order_id", "$.payload.before.order_id"], "value").alias("order_id"),
        cdc.first_json(["$.payload.source.missing", "$.payload.source.table"], "value").alias("source_table"),
    )


@query("cdc_plain_fields", f"""
WITH ev AS ({EVENTS_SQL})
SELECT status, CASE WHEN op <> 'd' THEN o_orderpriority END AS priority, count(*) AS n FROM ev GROUP BY 1, 2""")
def cdc_plain_fields(t: Tables) -> DataFrame:
    config = feed.TableConfig("orders", ("order_id",), tuple(f for f in feed.ORDERS.fields if f.transform == "plain"))
    return cdc.decode_events(feed.order_events(t), config).groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("cdc_epoch_micros", f"""
WITH ev AS ({EVENTS_SQL})
SELECT CAST(o_orderdate AS VARCHAR) AS ordered_at, count(*) AS n FROM ev WHERE op <> 'd' GROUP BY 1""")
def cdc_epoch_micros(t: Tables) -> DataFrame:
    config = feed.TableConfig("orders", ("ordered_at",), tuple(f for f in feed.ORDERS.fields if f.target == "ordered_at"))
    rows = cdc.decode_events(feed.order_events(t), config).filter("ordered_at is not null")
    return rows.groupBy("ordered_at").agg(F.count(F.lit(1)).alias("n"))


@query("cdc_decimal_bytes", f"""
WITH ev AS ({EVENTS_SQL})
SELECT o_orderkey * 4 + slot AS bronze_offset, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total FROM ev WHERE op <> 'd'""")
def cdc_decimal_bytes(t: Tables) -> DataFrame:
    config = feed.TableConfig("orders", ("total",), tuple(f for f in feed.ORDERS.fields if f.target == "total"))
    return cdc.decode_events(feed.order_events(t), config).filter("total is not null").select("bronze_offset", "total")


@query("cdc_decimal_json_paths", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
  CAST(CAST(c_acctbal AS DECIMAL(18,4)) AS DOUBLE) AS balance FROM customer""")
def cdc_decimal_json_paths(t: Tables) -> DataFrame:
    events = landing.normalise_landing(feed.customer_landing(t))
    return cdc.decode_events(events, feed.CUSTOMER).select("customer_id", "name", "balance")


@query("cdc_struct_decimal", """
SELECT c_custkey AS customer_id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer""")
def cdc_struct_decimal(t: Tables) -> DataFrame:
    """Typed decode of a struct-encoded decimal, as the per-table jobs did."""
    schema = "payload struct<after:struct<customer_id:bigint,balance:struct<scale:int,value:string>>>"
    after = F.from_json("value", schema)["payload"]["after"]
    rows = feed.customer_landing(t).select(after.alias("a")).select("a.customer_id", "a.balance")
    item = Encoded("decoded", F.col("balance.value"), 18, 2, F.coalesce("balance.scale", F.lit(2)))
    return with_decimals(rows, [item]).select("customer_id", F.col("decoded").alias("balance"))


def order_changes(t: Tables) -> DataFrame:
    decoded = cdc.decode_events(feed.order_events(t), feed.ORDERS)
    return upsert.latest_per_key(decoded, feed.ORDERS.primary_keys, feed.ORDERS.dedupe_order_columns)


def empty_orders(t: Tables) -> DataFrame:
    ddl = (
        "order_id string, customer_id string, status string, priority string, ordered_at timestamp, total decimal(12,2), "
        "last_inserted_dt timestamp, last_updated_dt timestamp"
    )
    return t.spark.createDataFrame([], ddl)


CURRENT_ORDERS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS status,
  o_orderpriority AS priority, CAST(o_orderdate AS VARCHAR) AS ordered_at,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total,
  CAST(o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 30 DAY END AS VARCHAR) AS last_inserted_dt,
  CAST(o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 30 DAY END AS VARCHAR) AS last_updated_dt
FROM orders WHERE NOT {DELETED}"""


@query("current_state_orders", CURRENT_ORDERS_SQL)
def current_state_orders(t: Tables) -> DataFrame:
    """Envelopes to current-state orders: decode, latest event per key, merge into an empty table."""
    return upsert.merge_changes(empty_orders(t), order_changes(t), ["order_id"])


@query("upsert_latest_per_key", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN {DELETED} THEN 'd' WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END AS op,
  CASE WHEN {DELETED} THEN NULL ELSE o_orderstatus END AS status FROM orders""")
def upsert_latest_per_key(t: Tables) -> DataFrame:
    return order_changes(t).select("order_id", "op", "status")


@query("upsert_keep_first", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def upsert_keep_first(t: Tables) -> DataFrame:
    return upsert.keep_first(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select(
        "user_id", "event_type", "event_id", "value"
    )


@query("upsert_merge", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '1990-01-01 00:00:00'
       ELSE CAST(o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 30 DAY END AS VARCHAR) END AS last_inserted_dt,
  CAST(o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 30 DAY END AS VARCHAR) AS last_updated_dt
FROM orders WHERE NOT {DELETED}
UNION ALL SELECT 'old-' || c_custkey, 'K', '1990-01-01 00:00:00', '1990-01-01 00:00:00' FROM customer""")
def upsert_merge(t: Tables) -> DataFrame:
    """Merge into a table holding older orders (updated or deleted) and keys without changes (kept)."""
    start = F.lit("1990-01-01").cast("timestamp")
    older = t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.lit("?").alias("status")
    )
    untouched = t.customer.select(F.concat(F.lit("old-"), F.col("c_custkey")).alias("order_id"), F.lit("K").alias("status"))
    target = older.unionByName(untouched).withColumns({"last_inserted_dt": start, "last_updated_dt": start})
    return upsert.merge_changes(target, order_changes(t), ["order_id"])


@query("upsert_merge_newer_only", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 0 DAY ELSE INTERVAL 30 DAY END >= TIMESTAMP '1998-06-01'
  THEN o_orderstatus ELSE 'stored' END AS status FROM orders
WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND o_orderdate + INTERVAL 60 DAY >= TIMESTAMP '1998-06-01')""")
def upsert_merge_newer_only(t: Tables) -> DataFrame:
    """With an ordering column, events older than the stored row change nothing."""
    target = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.lit("stored").alias("status"),
        F.unix_millis(F.lit("1998-06-01").cast("timestamp")).alias("event_ts_ms"),
    )
    return upsert.merge_changes(target, order_changes(t), ["order_id"], order_column="event_ts_ms").select("order_id", "status")


@query("upsert_batch_equals_stream", CURRENT_ORDERS_SQL)
def upsert_batch_equals_stream(t: Tables) -> DataFrame:
    """The same merge run as a checkpointed stream over landed files."""
    from tidemark.streaming.pipelines import CurrentStateStream

    table = scratch_path(t.spark, "silver")
    job = CurrentStateStream(feed.ORDERS, table, empty_orders(t).schema)
    job.run(landing.normalise_landing(landing.landing_stream(t.spark, landed(t), max_files_per_trigger=4)), scratch_path(t.spark, "state"))
    return job.read(t.spark).drop("event_ts_ms")


@query("upsert_refresh_since", """
SELECT p_partkey AS film_id, CASE WHEN p_size >= 25 THEN upper(p_name) ELSE p_name END AS title FROM part""")
def upsert_refresh_since(t: Tables) -> DataFrame:
    """Target holds films up to a date; the source has later or equal ones with new titles."""
    film = Shop(t).film.select("film_id", "title", "last_update")
    mark = F.date_add(F.lit("2000-01-01").cast("date"), 25).cast("timestamp_ntz")
    target = film.filter(F.col("last_update") <= mark)
    source = film.withColumn("title", F.upper("title"))
    return upsert.refresh_since(target, source, ["film_id"], "last_update").select("film_id", "title")


@query("upsert_insert_only", """
SELECT c_custkey AS customer_id, CASE WHEN c_acctbal >= 0 THEN 'stored' ELSE 'new' END AS origin FROM customer""")
def upsert_insert_only(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("customer_id"), F.lit("stored").alias("origin"))
    target = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"), F.lit("stored").alias("origin"))
    return upsert.insert_only(target, rows.withColumn("origin", F.lit("new")), ["customer_id"])


@query("upsert_update_or_insert", """
SELECT c_custkey AS customer_id, CASE WHEN c_acctbal >= 0 THEN 'new' ELSE 'stored' END AS origin FROM customer""")
def upsert_update_or_insert(t: Tables) -> DataFrame:
    target = t.customer.select(F.col("c_custkey").alias("customer_id"), F.lit("stored").alias("origin"))
    source = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"), F.lit("new").alias("origin"))
    return upsert.update_or_insert(target, source, ["customer_id"])


@query("upsert_status_update", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'REVIEW' ELSE o_orderstatus END AS o_orderstatus,
  o_orderstatus = 'P' AND o_totalprice > 400000 AS touched FROM orders""")
def upsert_status_update(t: Tables) -> DataFrame:
    hit = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").withColumn("touched", F.lit(False))
    return upsert.update_where(rows, hit, {"o_orderstatus": F.lit("REVIEW"), "touched": F.lit(True)}).drop("o_totalprice")


@query("upsert_latest_by_event_time", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN {DELETED} THEN 'd' WHEN o_orderstatus = 'O' THEN 'c' ELSE 'u' END AS op FROM orders""")
def upsert_latest_by_event_time(t: Tables) -> DataFrame:
    decoded = cdc.decode_events(feed.order_events(t), feed.ORDERS)
    return upsert.latest_per_key(decoded, ["order_id"], ["event_time"]).select("order_id", "op")


