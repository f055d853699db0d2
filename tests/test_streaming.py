"""Random event histories, cut into batches at random, against a plain fold over the events."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, upsert
from tidemark.operators.quality import QualityGateError
from tidemark.sources import landing
from tidemark.sources.contracts import Field, TableConfig
from tidemark.streaming.pipelines import BronzeIngest, CurrentStateStream

CONFIG = TableConfig("item", ("id",), (
    Field("id", source_paths=("after.id", "before.id")), Field("name", source_paths=("after.name", "before.name")),
))
DDL = "topic string, partition int, offset bigint, timestamp bigint, message_key string, value string"
SCHEMA = "id string, name string, last_inserted_dt timestamp, last_updated_dt timestamp"


def history(seed, n=120, ids=12):
    """Events as (offset, ts, op, id, name); times mostly rise but some events are late."""
    rng = random.Random(seed)
    return [
        (i, 1000 * i - (rng.randrange(60000) if rng.random() < 0.3 else 0) + 100000, rng.choice("ccuuud"), rng.randrange(ids), f"v{i}")
        for i in range(n)
    ]


def frame(spark, events):
    rows = []
    for offset, ts, op, key, name in events:
        before, after = ({"id": key}, None) if op == "d" else (None, {"id": key, "name": name})
        value = json.dumps({"payload": {"op": op, "ts_ms": ts, "before": before, "after": after, "source": {"table": "item"}}})
        rows.append(("cdc.public.item", 0, offset, ts, str(key), value))
    return landing.normalise_landing(spark.createDataFrame(rows, DDL))


def folded(events):
    newest = {}
    for offset, ts, op, key, name in events:
        if key not in newest or (ts, offset) > newest[key][0]:
            newest[key] = ((ts, offset), None if op == "d" else name)
    return {str(k): name for k, (_, name) in newest.items() if name is not None}


@pytest.mark.parametrize("seed", range(3))
def test_any_batching_gives_the_folded_state(spark, tmp_path, seed):
    events = history(seed)
    job = CurrentStateStream(CONFIG, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    job.create(spark)
    rng, start, batch = random.Random(seed), 0, 0
    while start < len(events):
        stop = start + rng.randrange(10, 50)
        part = frame(spark, events[start:stop])
        job.write_batch(part, batch)
        if rng.random() < 0.5:
            job.write_batch(part, batch)  # replayed after a failure
        if rng.random() < 0.5:
            job.compact(spark)
            job.compact(spark)
        start, batch = stop, batch + 1
    got = {r["id"]: r["name"] for r in job.read(spark).collect()}
    assert got == folded(events)
    whole = upsert.latest_per_key(
        cdc.decode_events(frame(spark, events), CONFIG), ["id"], CONFIG.dedupe_order_columns
    )
    batch_state = upsert.merge_changes(spark.createDataFrame([], SCHEMA), whole, ["id"])
    assert {r["id"]: r["name"] for r in batch_state.collect()} == got


def test_ties_in_time_go_by_offset_after_a_compaction(spark, tmp_path):
    job = CurrentStateStream(CONFIG, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    job.create(spark)
    for batch, offset in enumerate((11, 10, 12)):
        job.write_batch(frame(spark, [(offset, 5000, "u", 1, f"v{offset}")]), batch)
        job.compact(spark)
        assert [r["name"] for r in job.read(spark).collect()] == ["v12" if batch == 2 else "v11"]


def test_empty_stream_and_null_keys(spark, tmp_path):
    job = CurrentStateStream(CONFIG, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    job.create(spark)
    job.compact(spark)
    assert job.read(spark).isEmpty()
    with pytest.raises(QualityGateError):
        job.write_batch(frame(spark, [(1, 5000, "u", 1, "v"), (2, 5000, "u", None, "w")]), 0)
    assert job.read(spark).isEmpty()


def test_ingest_replay_does_not_duplicate(spark, tmp_path):
    events = frame(spark, history(1, n=20)).unionByName(
        frame(spark, history(2, n=1)).withColumn("value", F.lit("broken"))
    )
    job = BronzeIngest(str(tmp_path / "b"), str(tmp_path / "q"))
    job.write_batch(events, 0)
    job.write_batch(events, 0)
    assert spark.read.parquet(job.bronze_path).count() == 20
    assert [r["quarantine_reason"] for r in spark.read.parquet(job.quarantine_path).collect()] == ["invalid_json"]
