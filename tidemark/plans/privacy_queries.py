"""Queries: personal data registry, encryption, shredding and erasure.

Requests are derived from customers: those with a negative balance asked for erasure, and their
segment decides the request's state. Key material is derived from a fixed secret so that the
jobs are repeatable; only readable text, counts and states are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import erasure, privacy, upsert
from tidemark.plans import feed
from tidemark.plans.cdc_queries import EVENTS_SQL
from tidemark.plans.registry import query
from tidemark.session import Tables, scratch_path, stored
from tidemark.sources import landing

KIND = "silver_customer"
AT = "2002-01-01 00:00:00"

REQUESTS_SQL = """WITH req AS (SELECT 'req-' || c_custkey AS request_id,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS subject_id, 'silver_customer' AS subject_type,
  TIMESTAMP '2001-12-30' - INTERVAL 1 DAY * (c_nationkey * 2) AS requested_at,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'complete' WHEN 'MACHINERY' THEN 'suppressed' ELSE 'pending' END AS status, c_custkey
  FROM customer WHERE c_acctbal < 0),
acc AS (SELECT * FROM req WHERE status IN ('pending', 'suppressed') AND TRY_CAST(subject_id AS BIGINT) IS NOT NULL) """


def at(text: str = AT):
    return F.lit(text).cast("timestamp_ntz")


def requests(t: Tables) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return t.customer.filter("c_acctbal < 0").select(
        F.concat(F.lit("req-"), key).alias("request_id"),
        F.when(segment == "FURNITURE", F.concat(F.lit("x"), key)).otherwise(key.cast("string")).alias("subject_id"),
        F.lit(KIND).alias("subject_type"),
        F.timestamp_add("DAY", F.col("c_nationkey") * -2, F.lit("2001-12-30").cast("timestamp_ntz")).alias("requested_at"),
        F.when(segment == "BUILDING", "complete").when(segment == "MACHINERY", "suppressed").otherwise("pending").alias("status"),
    )


def no_keys(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(
        [], "subject_id string, subject_type string, dek binary, created_at timestamp_ntz, shredded_at timestamp_ntz"
    )


def key_table(t: Tables) -> DataFrame:
    created = privacy.missing_keys(t.customer.select("c_custkey"), no_keys(t), KIND, privacy.derived_key("drill"), at())
    return no_keys(t).unionByName(created)


def sealed(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return privacy.encrypt_columns(rows, key_table(t), ["c_name"], "c_custkey", KIND)


def empty_registry(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([], "subject_id string, subject_type string, suppressed_at timestamp_ntz")


@query("privacy_column_registry", """
SELECT 'customer' AS table_name, column_name, sensitivity, n_values FROM (
  SELECT 'c_name' AS column_name, 'high' AS sensitivity, count(c_name) AS n_values FROM customer UNION ALL
  SELECT 'c_acctbal', 'low', count(c_acctbal) FROM customer UNION ALL SELECT 'c_mktsegment', 'low', count(c_mktsegment) FROM customer)""")
def privacy_column_registry(t: Tables) -> DataFrame:
    """The registry after a second load changed one entry, with how many values each column holds."""
    entry = lambda column, level, encrypt: {
        "table": "customer", "column": column, "sensitivity": level, "subject_id_col": "c_custkey", "encrypt": encrypt
    }
    first = privacy.personal_columns([entry("c_name", "medium", False), entry("c_acctbal", "low", False)], t.spark)
    second = privacy.personal_columns([entry("c_name", "high", True), entry("c_mktsegment", "low", False)], t.spark)
    registry = upsert.update_or_insert(first, second, ["table_name", "column_name"])
    counts = t.customer.agg(*[F.count(c).alias(c) for c in ("c_name", "c_acctbal", "c_mktsegment")]).unpivot(
        [], ["c_name", "c_acctbal", "c_mktsegment"], "column_name", "n_values"
    )
    return registry.join(counts, "column_name").select("table_name", "column_name", "sensitivity", "n_values")


@query("privacy_key_map", """
SELECT CAST(c_custkey AS VARCHAR) AS subject_id, CASE WHEN c_acctbal >= 0 THEN '2001-01-01 00:00:00' ELSE '2002-01-01 00:00:00' END AS created_at,
  sha256('drill|silver_customer|' || c_custkey) AS dek FROM customer""")
def privacy_key_map(t: Tables) -> DataFrame:
    """Keys for new subjects only; those made earlier stay as they are."""
    early = privacy.missing_keys(
        t.customer.filter("c_acctbal >= 0").select("c_custkey"), no_keys(t), KIND, privacy.derived_key("drill"), at("2001-01-01")
    )
    late = privacy.missing_keys(t.orders.select("o_custkey").unionByName(t.customer.select(F.col("c_custkey").alias("o_custkey"))), early, KIND, privacy.derived_key("drill"), at())
    return early.unionByName(late).select("subject_id", "created_at", F.lower(F.hex("dek")).alias("dek"))


@query("privacy_encrypt", "SELECT c_custkey, c_mktsegment, true AS sealed, length(c_name) + 28 AS n_bytes FROM customer")
def privacy_encrypt(t: Tables) -> DataFrame:
    """Ciphertext differs on every run, so its form is compared: nonce and tag add 28 bytes."""
    return sealed(t).select(
        "c_custkey", "c_mktsegment", (F.col("c_name").cast("string") != F.lit("")).alias("sealed"),
        F.octet_length("c_name").cast("bigint").alias("n_bytes"),
    )


@query("privacy_round_trip", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_mktsegment IN ('HOUSEHOLD', 'AUTOMOBILE', 'MACHINERY') THEN '[ERASED]' ELSE c_name END AS c_name FROM customer""")
def privacy_round_trip(t: Tables) -> DataFrame:
    """Encrypt, shred the accepted requests' keys, decrypt: shredded names are gone, others readable."""
    shredded = privacy.shred(key_table(t), privacy.accepted(requests(t)), at())
    return privacy.decrypt_columns(sealed(t), shredded, ["c_name"], "c_custkey", KIND).select("c_custkey", "c_name")


@query("privacy_shred", REQUESTS_SQL + """
SELECT CAST(c.c_custkey AS VARCHAR) AS subject_id, a.subject_id IS NOT NULL AS is_shredded FROM customer c LEFT JOIN acc a ON a.c_custkey = c.c_custkey""")
def privacy_shred(t: Tables) -> DataFrame:
    shredded = privacy.shred(key_table(t), privacy.accepted(requests(t)), at())
    return shredded.select("subject_id", (F.col("dek").isNull() & F.col("shredded_at").isNotNull()).alias("is_shredded"))


@query("privacy_suppress", REQUESTS_SQL + "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM acc)")
def privacy_suppress(t: Tables) -> DataFrame:
    added, _ = privacy.register_suppression(empty_registry(t), requests(t), at())
    with_null = added.unionByName(added.limit(1).withColumn("subject_id", F.lit(None).cast("string")))
    return privacy.suppress_subjects(t.orders, with_null, "o_custkey", KIND).select("o_orderkey", "o_custkey")


@query("privacy_validate_requests", REQUESTS_SQL + """
SELECT request_id, CASE WHEN status = 'complete' THEN 'wrong_status' WHEN TRY_CAST(subject_id AS BIGINT) IS NULL THEN 'subject_not_integer' ELSE 'accepted' END AS verdict FROM req""")
def privacy_validate_requests(t: Tables) -> DataFrame:
    return privacy.validate_requests(requests(t)).select("request_id", "verdict")


@query("privacy_register_suppression", REQUESTS_SQL + """
SELECT 'registry' AS kind, subject_id AS id, 'suppressed' AS state FROM acc UNION ALL
SELECT 'request', r.request_id, CASE WHEN a.request_id IS NOT NULL THEN 'suppressed' ELSE r.status END FROM req r LEFT JOIN acc a ON a.request_id = r.request_id""")
def privacy_register_suppression(t: Tables) -> DataFrame:
    added, moved = privacy.register_suppression(empty_registry(t), requests(t), at())
    return added.select(F.lit("registry").alias("kind"), F.col("subject_id").alias("id"), F.lit("suppressed").alias("state")).unionByName(
        moved.select(F.lit("request").alias("kind"), F.col("request_id").alias("id"), F.col("status").alias("state"))
    )


@query("privacy_erase_events", REQUESTS_SQL + f", ev AS ({EVENTS_SQL}) " + """
SELECT o_orderkey * 4 + slot AS "offset", op FROM ev WHERE op = 'd' OR o_custkey NOT IN (SELECT c_custkey FROM acc)""")
def privacy_erase_events(t: Tables) -> DataFrame:
    """Raw events without those that name an accepted subject; key-only deletes name none."""
    subjects = privacy.accepted(requests(t)).select("subject_number")
    return privacy.erase_events(feed.order_events(t), subjects, "customer_id").select(
        "offset", F.get_json_object("value", "$.payload.op").alias("op")
    )


@query("privacy_erasure_preview", REQUESTS_SQL + f", ev AS ({EVENTS_SQL}) " + """
SELECT 'orders' AS table_name, count(*) AS n_events FROM ev WHERE op <> 'd' AND o_custkey IN (SELECT c_custkey FROM acc)""")
def privacy_erasure_preview(t: Tables) -> DataFrame:
    subjects = privacy.accepted(requests(t)).select("subject_number")
    return privacy.erasure_preview(feed.order_events(t), subjects, "customer_id")


@query("privacy_post_shred_check", REQUESTS_SQL + """
SELECT CAST(0 AS BIGINT) AS readable_values, count(*) AS rows_checked, 'PASS' AS status FROM acc""")
def privacy_post_shred_check(t: Tables) -> DataFrame:
    wanted = privacy.accepted(requests(t))
    shredded = privacy.shred(key_table(t), wanted, at())
    return privacy.still_readable(sealed(t), shredded, ["c_name"], "c_custkey", KIND, wanted)


@query("privacy_audit_log", REQUESTS_SQL + """
SELECT a.request_id, s.step, s.step_no FROM acc a, (SELECT 'validate' AS step, 0 AS step_no UNION ALL SELECT 'suppress', 1 UNION ALL SELECT 'shred', 2 UNION ALL SELECT 'complete', 3) s""")
def privacy_audit_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "audit")
    privacy.audit_rows(requests(t), ["validate", "suppress", "shred", "complete"], "run-1", at()).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("request_id", "step", "step_no")


@query("privacy_complete_requests", REQUESTS_SQL + """
SELECT request_id, CASE WHEN status = 'suppressed' THEN 'complete' ELSE status END AS status FROM req""")
def privacy_complete_requests(t: Tables) -> DataFrame:
    return privacy.complete_requests(requests(t)).select("request_id", "status")


@query("privacy_requests_due", REQUESTS_SQL + """
SELECT request_id, status, date_diff('day', requested_at, TIMESTAMP '2002-01-01')::INTEGER AS age_days, 30 - date_diff('day', requested_at, TIMESTAMP '2002-01-01')::INTEGER AS days_left,
  date_diff('day', requested_at, TIMESTAMP '2002-01-01') >= 25 AS approaching_limit FROM req WHERE status <> 'complete'""")
def privacy_requests_due(t: Tables) -> DataFrame:
    return privacy.requests_due(requests(t), at()).drop("subject_type")


@query("privacy_completed_trend", REQUESTS_SQL + """
SELECT CAST(date_trunc('month', requested_at)::DATE AS VARCHAR) AS month, count(*) AS n_completed FROM req WHERE status = 'complete' GROUP BY 1""")
def privacy_completed_trend(t: Tables) -> DataFrame:
    return privacy.completed_trend(requests(t))


@query("privacy_active_keys", REQUESTS_SQL + """
SELECT CAST(c_custkey AS VARCHAR) AS subject_id, 'silver_customer' AS subject_type FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM acc)""")
def privacy_active_keys(t: Tables) -> DataFrame:
    return privacy.active_keys(privacy.shred(key_table(t), privacy.accepted(requests(t)), at())).select("subject_id", "subject_type")


@query("privacy_random_keys", "SELECT count(*) AS n_keys, count(*) AS n_distinct, 32 AS shortest, 32 AS longest FROM customer")
def privacy_random_keys(t: Tables) -> DataFrame:
    """Fresh keys differ on every run, so their number, length and difference are compared."""
    keys = stored(privacy.missing_keys(t.customer.select("c_custkey"), no_keys(t), KIND, privacy.random_key(), at()), "keys")
    size = F.octet_length("dek")
    return keys.agg(F.count("dek").alias("n_keys"), F.count_distinct("dek").alias("n_distinct"), F.min(size).alias("shortest"), F.max(size).alias("longest"))


SCANS = {
    KIND: erasure.Scan(("orders", "customer"), ("customer_id",)),
    "silver_order": erasure.Scan(("orders",), ("order_id",)),
}


@query("privacy_erasure_run", REQUESTS_SQL + f""", ev AS ({EVENTS_SQL}), ord AS (
  SELECT 'ord-' || o_orderkey AS request_id, CAST(o_orderkey AS VARCHAR) AS subject_id, 'silver_order' AS subject_type, o_orderkey FROM orders WHERE o_totalprice > 400000),
every AS (SELECT request_id, subject_id, subject_type FROM acc UNION ALL SELECT request_id, subject_id, subject_type FROM ord),
named AS (
  SELECT a.request_id, count(*) AS n FROM acc a JOIN ev ON ev.o_custkey = a.c_custkey AND ev.op <> 'd' GROUP BY 1
  UNION ALL SELECT request_id, 1 FROM acc UNION ALL SELECT o.request_id, count(*) FROM ord o JOIN ev ON ev.o_orderkey = o.o_orderkey GROUP BY 1)
SELECT 'event' AS kind, 'orders:' || (o_orderkey * 4 + slot) AS id, op AS state FROM ev
WHERE NOT (op <> 'd' AND o_custkey IN (SELECT c_custkey FROM acc)) AND o_orderkey NOT IN (SELECT o_orderkey FROM ord)
UNION ALL SELECT 'event', 'customer:' || c_custkey, 'c' FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM acc)
UNION ALL SELECT 'request', request_id, CASE WHEN request_id IN (SELECT request_id FROM acc) THEN 'complete' ELSE status END FROM req
UNION ALL SELECT 'request', request_id, 'complete' FROM ord
UNION ALL SELECT 'registry', subject_type || ':' || subject_id, 'suppressed' FROM (SELECT DISTINCT subject_type, subject_id FROM every)
UNION ALL SELECT 'key', 'silver_customer:' || c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM acc) THEN 'gone' ELSE 'live' END FROM customer
UNION ALL SELECT 'key', 'silver_order:' || o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'gone' ELSE 'live' END FROM orders
UNION ALL SELECT 'audit', request_id, 'events=' || CAST(sum(n) AS BIGINT) FROM named GROUP BY request_id
UNION ALL SELECT 'check', request_id, 'PASS' FROM every""")
def privacy_erasure_run(t: Tables) -> DataFrame:
    """One run for customers and orders, some of which have equal ids: events, requests, registry, keys, audit and checks."""
    store = erasure.EventStore(t.spark, scratch_path(t.spark, "erasable"), SCANS)
    store.add(landing.normalise_landing(feed.order_landing(t), at().cast("timestamp")))
    store.add(landing.normalise_landing(feed.customer_landing(t), at().cast("timestamp")))
    asked = requests(t).unionByName(t.orders.filter("o_totalprice > 400000").select(
        F.concat(F.lit("ord-"), "o_orderkey").alias("request_id"), F.col("o_orderkey").cast("string").alias("subject_id"),
        F.lit("silver_order").alias("subject_type"), at().alias("requested_at"), F.lit("pending").alias("status")))
    order_keys = privacy.missing_keys(t.orders.select("o_orderkey"), no_keys(t), "silver_order", privacy.derived_key("drill"), at())
    done = erasure.run(store, asked, empty_registry(t), key_table(t).unionByName(order_keys), "run-1", at())
    subject = F.concat_ws(":", "subject_type", "subject_id")
    row = lambda df, kind, id, state: df.select(F.lit(kind).alias("kind"), id.alias("id"), state.alias("state"))
    return (
        row(store.events(), "event", F.concat_ws(":", "table_name", "offset"), F.get_json_object("value", "$.payload.op"))
        .unionByName(row(done.requests, "request", F.col("request_id"), F.col("status")))
        .unionByName(row(done.registry, "registry", subject, F.lit("suppressed")))
        .unionByName(row(done.keys, "key", subject, F.when(F.col("dek").isNull(), "gone").otherwise("live")))
        .unionByName(row(done.audit.filter("step = 'delete_events'"), "audit", F.col("request_id"), F.regexp_extract("evidence", "^events=[0-9]+", 0)))
        .unionByName(row(done.checks, "check", F.col("request_id"), F.col("status")))
    )
