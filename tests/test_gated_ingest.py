"""Gated ingest, deduplication across micro-batches, bucketed merges and the erasure run, with replays and failures."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import CONFIG, SCHEMA, frame, history
from tidemark.operators import cdc, erasure, privacy, upsert
from tidemark.operators.quality import QualityGateError
from tidemark.sources.buckets import BucketedTable
from tidemark.streaming.dedupe import DedupedIngest
from tidemark.streaming.gated import GatedIngest

ITEM = (("item", "id", "number"), ("item", "name", "string"))


def creations(spark, n, start=0, text=None):
    events = frame(spark, [(start + i, 1000 * i, "c", i, f"v{i}") for i in range(n)])
    return events if text is None else events.withColumn("value", F.replace("value", F.lit('"name": "v'), F.lit(text)))


def test_replay_leaves_one_copy_and_blocked_batches_are_not_visible(spark, tmp_path):
    job = GatedIngest(str(tmp_path / "g"), ITEM, on_block="stop")
    job.create(spark)
    assert job.events(spark).isEmpty() and job.quarantine(spark).isEmpty()
    mixed = creations(spark, 20).unionByName(creations(spark, 3, 50).withColumn("value", F.lit("{")))
    for _ in range(2):  # the second time as after a failure
        job.write_batch(mixed, 0)
    assert job.events(spark).count() == 20 and [r["quarantine_reason"] for r in job.quarantine(spark).collect()] == ["invalid_json"] * 3
    changed = creations(spark, 20, 100, '"extra": 1, "name": 4, "old": "v')
    with pytest.raises(QualityGateError, match="schema drift in 1 source"):
        job.write_batch(changed, 1)
    assert job.events(spark).count() == 20 and job.manifest(spark).filter("status = 'blocked'").count() == 1
    log = job.drift_log(spark).filter("batch = 1").first()
    assert (log["severity"], list(log["type_changes"]), sorted(log["added_columns"])) == ("CRITICAL", ["name"], ["extra", "old"])
    # the same batch again under another policy
    lenient = GatedIngest(job.path, ITEM, policy="permissive")
    lenient.write_batch(changed, 1)
    assert lenient.events(spark).count() == 40 and lenient.manifest(spark).count() == 2


def test_volume_gate_uses_published_batches_only(spark, tmp_path):
    job = GatedIngest(str(tmp_path / "g"), ITEM, volume_blocks=("FAIL", "WARN"), on_block="skip", lookback=2)
    job.create(spark)
    for batch, n in enumerate((40, 30, 10, 20, 12)):
        job.write_batch(creations(spark, n, 1000 * batch), batch)
    got = {r["batch"]: (r["n_rows"], r["rolling_average"], r["status"]) for r in job.volume_log(spark).collect()}
    assert got == {0: (40, None, "PASS"), 1: (30, 40.0, "PASS"), 2: (10, 35.0, "WARN"), 3: (20, 35.0, "PASS"), 4: (12, 25.0, "WARN")}
    assert {r[0] for r in job.published(spark).collect()} == {0, 1, 3} and job.events(spark).count() == 90


def test_unusable_share_empty_batches_and_sources_without_contract(spark, tmp_path):
    job = GatedIngest(str(tmp_path / "g"), (), most_unusable=0.5, on_block="skip")
    job.create(spark)
    job.write_batch(creations(spark, 5).limit(0), 0)
    assert job.manifest(spark).isEmpty()
    job.write_batch(creations(spark, 5).withColumn("value", F.lit(None).cast("string")), 1)
    job.write_batch(creations(spark, 5), 2)
    got = {r["batch"]: (r["status"], r["n_events"], r["n_quarantined"]) for r in job.manifest(spark).collect()}
    assert got == {1: ("blocked", 5, 5), 2: ("published", 5, 0)} and job.events(spark).count() == 5 and job.drift_log(spark).isEmpty()


def test_duplicates_in_different_batches_give_one_row(spark, tmp_path):
    schema, source, state = "id long, ts timestamp, batch_no int", str(tmp_path / "in"), str(tmp_path / "state")
    job = DedupedIngest(str(tmp_path / "out"), ("id",), "ts", "1 hour")
    minute = lambda ids, n: spark.range(*ids).select("id", F.timestamp_seconds(F.col("id") * 60 + 60).alias("ts"), F.lit(n).alias("batch_no"))
    for n, ids in enumerate(((0, 100), (80, 300), (290, 400), (0, 20))):  # the last ones come back when their keys are forgotten
        minute(ids, n).write.mode("append").parquet(source)
        job.run(spark.readStream.schema(schema).parquet(source), state)
    assert sorted(r["id"] for r in job.rows(spark).collect()) == list(range(400))
    assert job.rows(spark).filter("id = 85").first()["batch_no"] == 0
    log = job.log(spark).agg(F.sum("n_duplicates"), F.sum("n_late"), F.sum("n_input"), F.sum("n_output")).first()
    assert tuple(log) == (30, 20, 450, 400)
    held = job.log(spark).orderBy(F.col("batch").desc()).first()["n_state_rows"]
    assert held < 200  # those of the last hours, not all 400


def test_bucketed_merge_equals_the_merge_and_touches_only_its_buckets(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), ("id",), spark.createDataFrame([], SCHEMA).schema, buckets=32)
    table.load(spark.createDataFrame([], SCHEMA))
    want, events = spark.createDataFrame([], SCHEMA), history(7, n=200, ids=60)
    for part in (events[:150], events[150:160], [(999, 10**9, "d", key, None) for key in range(60)][:55]):
        changes = upsert.latest_per_key(cdc.decode_events(frame(spark, part), CONFIG), ["id"], CONFIG.dedupe_order_columns)
        before = set(spark.read.parquet(table.path).inputFiles())
        touched = table.merge(changes)
        again = table.merge(changes)  # run once more after a failure
        assert touched == again == table.touched(changes)
        want = spark.createDataFrame(upsert.merge_changes(want, changes, ["id"]).collect(), SCHEMA)
        assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, want.collect()))
        kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
        assert kept <= set(spark.read.parquet(table.path).inputFiles())
    assert 0 < table.read(spark).count() <= 5
    plan = table.read(spark, [3])._jdf.queryExecution().executedPlan().toString()
    assert "_bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert table.merge(changes.limit(0)) == []


SCANS = {"customer": erasure.Scan(("customer", "rental"), ("customer_id",)), "staff": erasure.Scan(("staff", "rental"), ("staff_id", "manager_id"))}


def erasable(spark, path):
    """Three loads, so that files of different subjects exist."""
    store, rows, offset = erasure.EventStore(spark, str(path), SCANS), [], 0
    for table, ids in (("customer", (1, 2)), ("rental", (1,)), ("rental", (2, 3)), ("staff", (1, 3)), ("store", (1,))):
        batch = []
        for i in ids:
            image = {"customer_id": i, "staff_id": 10 + i, "manager_id": i} if table != "staff" else {"staff_id": i}
            payload = {"after": image} if table == "customer" else {"payload": {"before": None, "after": image}}
            batch.append((f"cdc.public.{table}", 0, offset, table, json.dumps(payload)))
            offset += 1
        store.add(spark.createDataFrame(batch, "topic string, partition int, offset bigint, table_name string, value string").coalesce(1))
        rows += batch
    return store, rows


def erase(spark, store, asked, run_id="r1"):
    requests = spark.createDataFrame([(f"q{i}", s, k, "pending") for i, (k, s) in enumerate(asked)], "request_id string, subject_id string, subject_type string, status string")
    at = F.lit("2002-01-01").cast("timestamp_ntz")
    registry = spark.createDataFrame([], "subject_id string, subject_type string, suppressed_at timestamp_ntz")
    keys = spark.createDataFrame([(str(i), k, bytearray(b"k" * 32), None, None) for k in ("customer", "staff") for i in (1, 2, 3)],
                                 "subject_id string, subject_type string, dek binary, created_at timestamp_ntz, shredded_at timestamp_ntz")
    return erasure.run(store, requests, registry, keys, run_id, at)


def test_erasure_of_two_types_with_equal_ids(spark, tmp_path):
    store, rows = erasable(spark, tmp_path / "e")
    before = set(store.files())
    state = erase(spark, store, [("customer", "2"), ("staff", "3"), ("customer", "x"), ("unknown", "1")])
    left = {r["offset"] for r in store.events().collect()}
    # customer 2 in customer and rental; staff 3 as manager in the same rental file and in staff, but customer 3 alone is no reason
    assert left == {0, 2, 5, 7}
    gone = before - set(store.files())
    assert len(gone) == 3 and len(before & set(store.files())) == 2
    assert {r["request_id"]: r["status"] for r in state.requests.collect()} == {"q0": "complete", "q1": "complete", "q2": "pending", "q3": "complete"}
    assert {(r["subject_type"], r["subject_id"]) for r in state.registry.collect()} == {("customer", "2"), ("staff", "3"), ("unknown", "1")}
    assert {(r["subject_type"], r["subject_id"]) for r in state.keys.filter("dek is null").collect()} == {("customer", "2"), ("staff", "3")}
    assert {r["status"] for r in state.checks.collect()} == {"PASS"}
    texts = {(r["request_id"], r["step"]): r["evidence"] for r in state.audit.collect()}
    assert texts[("q0", "delete_events")] == "events=2, files=2" and texts[("q3", "delete_events")] == "events=0, files=0" and len(texts) == 18
    assert store.named(spark.createDataFrame([("customer", "2")], "subject_type string, subject_id string")).isEmpty()
    assert {(r["subject_type"], r["subject_id"]) for r in store.index().collect()} == {("customer", "1"), ("staff", "1"), ("staff", "11")}


def test_erasure_is_completed_after_a_stop_and_repeated_without_effect(spark, tmp_path, monkeypatch):
    store, _ = erasable(spark, tmp_path / "e")
    subjects = spark.createDataFrame([("customer", "1")], "subject_type string, subject_id string")

    def stop(staged):
        raise RuntimeError("stopped")

    monkeypatch.setattr(store, "_move_in", stop)
    with pytest.raises(RuntimeError):
        store.erase(subjects, "r1")
    monkeypatch.undo()
    store.erase(subjects, "r1")
    assert sorted(r["offset"] for r in store.events().collect()) == [1, 3, 4, 5, 6, 7]
    files = store.files()
    assert store.erase(subjects, "r2") == [] and store.files() == files


def test_ids_of_a_parsed_text_are_those_of_paths(spark):
    texts = [
        '{"payload":{"before":{"customer_id":1},"after":{"customer_id":2,"x":"customer_id"}}}', '{"after":{"customer_id":3}}',
        '{"payload":{"after":{"customer_id":4,"customer_id":5}}}', '{"payload":{"after":{},"after":{"customer_id":6}}}',
        '{"payload":{"after":{"customer\\u005fid":7}}}', '{"payload":{"after":{"customer_id":"a8"},"before":{"customer_id":"9"}}}',
        '{"payload":{"after":{"customer_id":10}', '{"after":{"customer_id":11}} }x', '{"after":{"customer_id":1.50}}', '{"after":{"customer_id":{"a": 1}}}',
        '{"payload":[{"after":{"customer_id":12}}]}', '{"after":"{\\"customer_id\\":13}"}', '{"after":{"customer_id":null}}', "", None, "[]", '{"after":{"customer_id":14},"customer_id":15}',
    ]
    rows = spark.createDataFrame([(i, "customer", t) for i, t in enumerate(texts)], "i int, table_name string, value string")
    plain = ["customer_id", "staff_id"]
    both = rows.withColumn("_images", F.from_json("value", erasure.image_schema(plain))).select(
        "i", erasure.subject_ids(SCANS["customer"], plain).alias("parsed"), erasure.subject_ids(SCANS["customer"]).alias("paths"))
    found = {r["i"]: (r["parsed"], r["paths"]) for r in both.collect()}
    assert all(a == b for a, b in found.values()), found
    assert sorted(found[0][0]) == ["1", "2"] and found[1][0] == ["3"] and found[2][0] == ["4"] and sorted(found[5][0]) == ["9", "a8"]


def test_erasure_holds_requests_in_tables(spark, tmp_path, monkeypatch):
    store, _ = erasable(spark, tmp_path / "e")
    collected = []
    real = type(store.events()).collect
    monkeypatch.setattr(type(store.events()), "collect", lambda df: collected.append(df.columns) or real(df))
    state = erase(spark, store, [("customer", "2"), ("staff", "3"), ("customer", "2")])
    assert collected and all(c == ["file"] for c in collected)  # names of files alone reach the driver
    assert {r["status"] for r in state.checks.collect()} == {"PASS"}


def test_random_keys_differ(spark, tmp_path):
    keys = privacy.missing_keys(spark.range(300), spark.createDataFrame([], "subject_id string, subject_type string"), "t", privacy.random_key(), F.current_timestamp())
    keys.write.parquet(str(tmp_path / "k"))
    stored = spark.read.parquet(str(tmp_path / "k")).agg(F.count_distinct("dek"), F.min(F.octet_length("dek")), F.max(F.octet_length("dek"))).first()
    assert tuple(stored) == (300, 32, 32)
