"""Decoding, validation and merge rules on hand-made events."""

import base64
import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.decimals import Encoded, with_decimals
from tidemark.functions.payloads import extended_reason, quarantine_reason
from tidemark.operators import cdc, upsert
from tidemark.sources import landing, sinks
from tidemark.sources.contracts import Field, TableConfig, contract


def encode(value: int) -> str:
    size = max(1, (value.bit_length() + 8) // 8)
    return base64.b64encode(value.to_bytes(size, "big", signed=True)).decode()


def decode(spark, values, scale=0):
    rows = spark.createDataFrame([(i, encode(v)) for i, v in enumerate(values)], "i int, b string")
    out = with_decimals(rows, [Encoded("d", F.col("b"), 38, scale)])
    return [r["d"] for r in out.orderBy("i").collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**37), 10**37), min_size=20, max_size=60))
def test_signed_decimals_of_any_width(spark, values):
    assert decode(spark, values) == [Decimal(v) for v in values]


def test_decimal_edges(spark):
    values = [0, -1, 1, 127, 128, -128, -129, 255, 2**63 - 1, -(2**63), 2**63, 2**64, -(2**64) - 1, 10**37]
    assert decode(spark, values) == [Decimal(v) for v in values]
    assert decode(spark, [-1, 12345, -12345, 5], scale=3) == [Decimal(v) / 1000 for v in (-1, 12345, -12345, 5)]
    bad = spark.createDataFrame([("",), (None,), ("!!",), (encode(2**200),)], "b string")
    assert {r["d"] for r in with_decimals(bad, [Encoded("d", F.col("b"), 38, 0)]).collect()} == {None}


def test_row_scale_and_narrow_target(spark):
    rows = spark.createDataFrame([(encode(123456), 4), (encode(-7), 0), (encode(5), 3), (encode(10**12), 0)], "b string, s int")
    out = with_decimals(rows, [Encoded("d", F.col("b"), 8, 4, F.col("s"))])
    assert [r["d"] for r in out.collect()] == [Decimal("12.3456"), Decimal("-7.0000"), Decimal("0.0050"), None]


CASES = [
    (None, "null_or_empty_value"), ("", "null_or_empty_value"), (" \n\t", "null_or_empty_value"), ('{"a":1}', None),
    ('  {"a":{"b":"}{"}} \n', None), ('{"a":"\\"}"}', None), ('{"a":1', "invalid_json"), ('{"a":1} x', "invalid_json"),
    ('{"a":1}}', "invalid_json"), ("[1]", "invalid_json"), ("3", "invalid_json"), ("oops", "invalid_json"), ('{"a":1,"a":2}', None),
]


def test_quarantine_reasons(spark):
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "i int, value string")
    got = [r["r"] for r in rows.select("i", quarantine_reason(F.col("value")).alias("r")).orderBy("i").collect()]
    assert got == [reason for _, reason in CASES]


def test_long_values_with_many_escapes(spark):
    text = json.dumps({"a": 'x"\\{\n' * 40000, "b": {"c": "}" * 40000}})
    rows = spark.createDataFrame([(text,), (text + "}",), (text[:-1],)], "value string")
    got = [r[0] for r in rows.select(quarantine_reason(F.col("value"))).collect()]
    assert got == [None, "invalid_json", "invalid_json"]


def test_extended_reasons(spark):
    event = lambda **kw: json.dumps({"payload": {"op": "c", "ts_ms": 1704067200000, "source": {"table": "t"}, **kw}})
    cases = [
        (event(), None), (event(op="z"), "invalid_op"), (event(op=None), "invalid_op"), (event(source={}), "missing_source_table"),
        (event(ts_ms=1703900000000), "stale_event"), ("{", "json_parse_error"), (None, "null_value"),
    ]
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, value string")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    got = [r["r"] for r in rows.select("i", extended_reason(F.col("value"), now).alias("r")).orderBy("i").collect()]
    assert got == [reason for _, reason in cases]


CONFIG = TableConfig(
    "item", ("id",),
    (
        Field("id", source_paths=("after.id", "before.id")),
        Field("name", source_paths=("after.name", "before.name")),
    ),
)


def events(spark, rows):
    """rows: (offset, ts_ms, op, before, after)."""
    data = [
        ("cdc.public.item", 0, o, ts, str(o), json.dumps({"payload": {"op": op, "ts_ms": ts, "before": b, "after": a}}))
        for o, ts, op, b, a in rows
    ]
    raw = spark.createDataFrame(data, "topic string, partition int, offset bigint, timestamp bigint, message_key string, value string")
    return landing.normalise_landing(raw)


def changes(spark, rows):
    return upsert.latest_per_key(cdc.decode_events(events(spark, rows), CONFIG), ["id"], CONFIG.dedupe_order_columns)


def empty(spark):
    return spark.createDataFrame([], "id string, name string, event_ts_ms bigint, last_inserted_dt timestamp, last_updated_dt timestamp")


def state(df):
    return {r["id"]: r["name"] for r in df.collect()}


BATCH = [
    (1, 1000, "c", None, {"id": 1, "name": "a"}),
    (2, 2000, "u", {"id": 1}, {"id": 1, "name": "b"}),
    (3, 3000, "d", {"id": 1}, None),
    (4, 1500, "c", None, {"id": 2, "name": "x", "extra": 5}),
    (5, 1600, "u", {"id": 2}, {"id": 2}),
]


def test_create_update_delete_in_one_batch(spark):
    assert state(upsert.merge_changes(empty(spark), changes(spark, BATCH), ["id"])) == {"2": None}


def test_replayed_batch_changes_nothing(spark):
    once = upsert.merge_changes(empty(spark), changes(spark, BATCH), ["id"])
    twice = upsert.merge_changes(once, changes(spark, BATCH), ["id"])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_late_event_is_ignored_only_with_an_order_column(spark):
    first = upsert.merge_changes(empty(spark), changes(spark, [(9, 5000, "c", None, {"id": 1, "name": "new"})]), ["id"])
    late = changes(spark, [(10, 100, "u", None, {"id": 1, "name": "old"})])
    assert state(upsert.merge_changes(first, late, ["id"])) == {"1": "old"}
    assert state(upsert.merge_changes(first, late, ["id"], order_column="event_ts_ms")) == {"1": "new"}


def test_first_insert_time_is_kept(spark):
    first = upsert.merge_changes(empty(spark), changes(spark, [(1, 0, "c", None, {"id": 1, "name": "a"})]), ["id"])
    update = changes(spark, [(2, 60000, "u", None, {"id": 1, "name": "b"})])
    second = upsert.merge_changes(first, update, ["id"]).first()
    assert (second["last_inserted_dt"].minute, second["last_updated_dt"].minute) == (0, 1)
    moved = upsert.merge_changes(first, update, ["id"], keep_first_insert_time=False).first()
    assert moved["last_inserted_dt"].minute == 1


def test_unmatched_topics_are_dropped(spark):
    raw = spark.createDataFrame([("cdc.a.b",), ("cdc.a",), ("x.y.z.w",), (None,)], "topic string").select(
        "topic", F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.lit(0).alias("timestamp"), F.lit("").alias("message_key"), F.lit("{}").alias("value")
    )
    assert [(r["source_schema"], r["table_name"]) for r in landing.normalise_landing(raw).collect()] == [("a", "b")]


def test_unknown_transform_and_contract_are_errors(spark):
    with pytest.raises(ValueError):
        cdc.decode_events(events(spark, BATCH), TableConfig("t", ("id",), (Field("id", "rot13", ("after.id",)),)))
    with pytest.raises(KeyError):
        contract("bronze.nothing")


def test_keep_first_plan_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = upsert.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_first_with_ties_and_nulls(spark):
    rows = spark.createDataFrame(
        [(7, "late", 30), (7, "early", 10), (7, "unknown", None), (None, "a", 2), (None, "b", 5), (8, "same", 1), (8, "same", 1)],
        "sensor int, reading string, taken int")
    got = upsert.keep_first(rows, ["sensor"], [F.col("taken").asc_nulls_last()])
    assert sorted(map(repr, map(tuple, got.collect()))) == ["(7, 'early', 10)", "(8, 'same', 1)", "(None, 'a', 2)"]


def test_replaced_slices_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_slices(spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string"), path, ["d"])
    for _ in range(2):
        sinks.replace_slices(spark.createDataFrame([(3, "b")], "v int, d string"), path, ["d"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (3, "b")}


def test_config_from_dict_and_merge_columns(spark):
    config = TableConfig.from_dict("item", {
        "primary_keys": ["id"], "dedupe_order_columns": ["event_ts_ms"], "merge_core_fields": ["id", "name"], "fk_references": {"a": "b"},
        "field_mappings": [
            {"target": "id", "source_paths": ["after.id", "before.id"], "note": "ignored"},
            {"target": "price", "transform": "decimal_from_json_paths", "precision": 12, "scale": 2,
             "json_value_paths": ["$.payload.after.price.value"], "json_scale_paths": ["$.payload.after.price.scale"]},
        ],
    })
    rows = events(spark, [(1, 0, "c", None, {"id": 7, "price": {"value": encode(-12345), "scale": 3}})])
    row = cdc.decode_events(rows, config).first()
    assert (row["id"], row["price"], config.merge_columns) == ("7", Decimal("-12.35"), ("id", "name"))


def test_scratch_folder_is_shared_in_every_mode():
    from tidemark.session import scratch_path

    class Bare:
        class conf:
            settings = {"spark.sql.warehouse.dir": "hdfs://house/"}
            get = staticmethod(lambda key, default=None: Bare.conf.settings.get(key, default))

    assert scratch_path(Bare, "x").startswith("hdfs://house/_shared/x-") and scratch_path(Bare, "x") != scratch_path(Bare, "x")
    Bare.conf.settings["spark.checkpoint.dir"] = "s3://shared/"
    assert scratch_path(Bare, "x").startswith("s3://shared/x-")


@pytest.mark.parametrize(("text", "good"), [
    ('{"a":1}{"b":2}', False), ('{"a":1},{"b":2}', False), ('{"a":1} x {"b":2}', False), ('{"a":1},"x":{"b":2}', False),
    ('{"a":1}}{"b":{"c":1}', False), ('{"a":1}] [{"b":2}', False), ("{'a':1}", False), ('{"a":NaN', False), ("", False),
    ('{"a":1,"a":2}', True), (' \n{"a":{"b":"}{\'"}}\t', True), ('{"a":"' + "x" * 100000 + '"}', True), ("{}", True),
])
def test_only_one_whole_object_is_valid(spark, text, good):
    from tidemark.functions.payloads import is_json_object

    frame = spark.createDataFrame([(text,)], "v string").repartition(1)
    assert bool(frame.select(is_json_object(F.col("v"))).first()[0]) is good


def test_counted_append_of_rows_and_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append_counted(spark.range(5), path) == 5
    assert sinks.append_counted(spark.range(5).filter("id < 0"), path) == 0
    assert sinks.append_counted(spark.range(5).join(spark.range(0), "id"), path) == 0
    assert spark.read.parquet(path).count() == 5
