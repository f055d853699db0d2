"""Vault rules, privacy invariants, drift policies and quality gates."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import business_hash, packed, surrogate_key, unpacked
from tidemark.operators import drift, privacy, quality, snapshots, vault


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def sat(spark, rows):
    """rows: (key, load date, value)."""
    return spark.createDataFrame(rows, "hk string, load_date string, v string").select(
        "hk", F.col("load_date").cast("timestamp_ntz").alias("load_date"), F.sha2("v", 256).alias("diff_hk"), "v"
    )


def test_return_to_an_old_value(spark):
    stored = sat(spark, [("a", "2020-01-01", "A"), ("a", "2020-01-02", "B")])
    back = sat(spark, [("a", "2020-01-03", "A"), ("b", "2020-01-03", "A")])
    assert {r["hk"] for r in vault.changed_versions(stored, back, "hk").collect()} == {"a", "b"}
    assert {r["hk"] for r in vault.unseen_versions(stored, back, "hk").collect()} == {"b"}
    grown = stored.unionByName(vault.changed_versions(stored, back, "hk"))
    assert vault.changed_versions(grown, back, "hk").isEmpty()


def test_hash_null_positions(spark):
    row = spark.createDataFrame([("a", None)], "x string, y string")
    skip = row.select(business_hash(["x", "y"]) == business_hash(["y", "x"])).first()[0]
    kept = row.select(business_hash(["x", "y"], "^^") == business_hash(["y", "x"], "^^")).first()[0]
    assert skip and not kept


def test_surrogate_key_golden(spark):
    row = spark.createDataFrame([("a", None, "c")], "c1 string, c2 string, c3 string")
    want = row.select(F.md5(F.lit("a-_dbt_utils_surrogate_key_null_-c"))).first()[0]
    assert row.select(surrogate_key(["c1", "c2", "c3"])).first()[0] == want


def test_hub_folds_case_and_padding(spark):
    src = spark.createDataFrame([("x",), (" X",), ("y",)], "k string")
    rows = vault.hub_rows(src, ["k"], "hk", at("2020-01-01"), "s")
    assert rows.count() == 2
    assert vault.load_hub(rows, rows, "hk").count() == 2


def test_link_keeps_one_row_per_hash_with_nulls(spark):
    src = spark.createDataFrame([(1, None), (None, 1), (1, 2), (1, 2)], "a int, b int")
    rows = vault.link_rows(src, {"a_hk": "a", "b_hk": "b"}, "lk", at("2020-01-01"), "s")
    assert rows.count() == rows.select("lk").distinct().count() == 2


def test_daily_snapshots_equal_brute_force(spark):
    versions = [("a", "2020-01-01", "1"), ("a", "2020-01-03 10:00:00", "2"), ("a", "2020-01-03 11:00:00", "3"), ("b", "2020-01-05", "4"), ("z", "2020-01-01", "9")]
    second = [("b", "2019-06-01", "p"), ("a", "2020-01-04", "q"), ("a", "2020-02-01", "r")]
    hub = spark.createDataFrame([("a",), ("b",), ("c",)], "hk string")
    days = [f"2020-01-0{d}" for d in range(1, 7)]
    pit = snapshots.point_in_time_daily(
        hub, "hk", {"s": sat(spark, versions), "t": sat(spark, second)}, F.lit(days[0]).cast("date"), F.lit(days[-1]).cast("date")
    )
    got = {(r["hk"], str(r["snapshot_date"])): (r["s_load_date"], r["t_load_date"]) for r in pit.collect()}

    def newest(rows, key, day):
        loaded = [d if len(d) > 10 else d + " 00:00:00" for k, d, _ in rows if k == key]
        return max([d for d in loaded if d <= day + " 00:00:00"], default=None)

    want = {(k, d): (newest(versions, k, d), newest(second, k, d)) for k in "abc" for d in days}
    assert {k: tuple(v and str(v) for v in pair) for k, pair in got.items()} == want


def test_point_in_time_gives_null_columns_for_an_absent_satellite(spark):
    hub = spark.createDataFrame([("a",)], "hk string")
    row = snapshots.point_in_time(hub, "hk", {"gone": None}, F.lit("2020-01-01").cast("date")).first()
    assert row["gone_load_date"] is None and row["gone_diff_hk"] is None


def people(spark):
    return spark.createDataFrame([(1, "Ann"), (2, None), (3, "Bob"), (None, "Nobody")], "id int, name string")


def keys(spark):
    none = spark.createDataFrame([], "subject_id string, subject_type string, dek binary, created_at timestamp_ntz, shredded_at timestamp_ntz")
    return privacy.missing_keys(people(spark).select("id"), none, "p", privacy.derived_key("s"), at("2020-01-01"))


def test_encrypt_decrypt_shred(spark):
    sealed = privacy.encrypt_columns(people(spark), keys(spark), ["name"], "id", "p")
    assert [r["name"] for r in privacy.decrypt_columns(sealed, keys(spark), ["name"], "id", "p").orderBy("id").collect()] == [None, "Ann", None, "Bob"]
    asked = spark.createDataFrame([("3", "p")], "subject_id string, subject_type string")
    gone = privacy.shred(keys(spark), asked, at("2020-02-01"))
    names = {r["id"]: r["name"] for r in privacy.decrypt_columns(sealed, gone, ["name"], "id", "p").collect()}
    assert names[3] == "[ERASED]" and names[1] == "Ann" and names[2] is None
    assert privacy.still_readable(sealed, gone, ["name"], "id", "p", asked).first()["status"] == "PASS"
    assert privacy.still_readable(sealed, keys(spark), ["name"], "id", "p", asked).first()["status"] == "FAIL"


def test_shredded_subject_gets_no_new_key(spark):
    asked = spark.createDataFrame([("3", "p")], "subject_id string, subject_type string")
    gone = privacy.shred(keys(spark), asked, at("2020-02-01"))
    assert privacy.missing_keys(people(spark).select("id"), gone, "p", privacy.derived_key("s"), at("2020-03-01")).isEmpty()
    again = privacy.shred(gone, asked, at("2021-01-01")).filter("subject_id = '3'").first()
    assert again["shredded_at"].year == 2020


def test_suppression_ignores_null_registry_rows(spark):
    registry = spark.createDataFrame([("1", "p"), (None, "p"), ("3", "other")], "subject_id string, subject_type string")
    kept = privacy.suppress_subjects(people(spark), registry, "id", "p")
    assert {r["id"] for r in kept.collect()} == {2, 3, None}
    assert {r["id"] for r in privacy.suppress_subjects(people(spark), registry, "id", "p", strict_nulls=True).collect()} == {2, 3}


def test_events_are_erased_in_both_nestings(spark):
    events = spark.createDataFrame([
        ("t", 0, 1, '{"payload":{"after":{"id":1}}}'), ("t", 0, 2, '{"before":{"id":1},"after":{"id":2}}'),
        ("t", 0, 3, '{"after":{"id":2}}'), ("t", 1, 1, "{}"),
    ], "topic string, partition int, offset bigint, value string").withColumn("table_name", F.col("topic"))
    subject = spark.createDataFrame([(1,)], "s int")
    assert {r["value"] for r in privacy.erase_events(events, subject, "id").collect()} == {'{"after":{"id":2}}', "{}"}
    assert privacy.erasure_preview(events, subject, "id").first()["n_events"] == 2


def verdict(spark, changes, policy, **kw):
    df = spark.createDataFrame(changes, "t string, field string, change string")
    tables = spark.createDataFrame([("a",)], "t string")
    return drift.drift_severity(df.filter("t = 'a'"), tables, "t", policy, **kw).first()


@pytest.mark.parametrize("changes,policy,severity,valid", [
    ([("b", "f", "added")], "strict", "NONE", True),
    ([("a", "f", "added")], "strict", "WARNING", False),
    ([("a", "f", "added")], "additive_only", "WARNING", True),
    ([("a", "f", "removed")], "additive_only", "CRITICAL", False),
    ([("a", "f", "type_changed")], "permissive", "CRITICAL", True),
    ([("a", None, "unparsed")], "strict", "WARNING", False),
    ([("a", None, "unparsed")], "additive_only", "WARNING", True),
])
def test_drift_policies(spark, changes, policy, severity, valid):
    row = verdict(spark, changes, policy)
    assert (row["severity"], row["is_valid"]) == (severity, valid)


def test_field_types_are_those_of_the_json(spark):
    objects = ['{"a":1,"b":"2","c":{"x":1},"d":[1],"e":true,"f":null,"g":1.5}', '{"a":"1"}', "[1]", "oops", None]
    df = spark.createDataFrame([("t", o) for o in objects], "t string, j string")
    got = {(r["field"], r["json_type"]): r["n_events"] for r in drift.field_profile(df, F.col("j"), "t").collect()}
    assert got == {
        ("a", "number"): 1, ("a", "string"): 1, ("b", "string"): 1, ("c", "object"): 1, ("d", "array"): 1,
        ("e", "boolean"): 1, ("f", "null"): 1, ("g", "number"): 1, (None, "unparsed"): 3,
    }
    contract = spark.createDataFrame([("t", f, k) for f, k in (("a", "number"), ("b", "string"), ("f", "string"), ("z", "string"))], "t string, field string, json_type string")
    changes = {r["field"]: r["change"] for r in drift.classify_drift(drift.field_profile(df, F.col("j"), "t"), contract, "t").collect()}
    assert changes == {"a": "type_changed", "c": "added", "d": "added", "e": "added", "g": "added", "z": "removed", None: "unparsed"}


def test_profile_reads_both_images_and_repeated_keys_once_an_event(spark):
    rows = [('{"a":1,"a":"x"}', '{"a":2,"b":null}'), (None, '{"a":3}'), ('{"b":1', '{"b":2}'), ('{"o":{"x":1,"x":2}}', None)]
    df = spark.createDataFrame([("t", *r) for r in rows], "t string, before string, after string")
    got = {(r["field"], r["json_type"]): r["n_events"] for r in drift.field_profile(df, [F.col("before"), F.col("after")], "t").collect()}
    assert got == {("a", "number"): 2, ("a", "string"): 1, ("b", "null"): 1, ("b", "number"): 1, (None, "unparsed"): 2}


def test_lenient_strict_policy_and_gate(spark):
    assert verdict(spark, [("a", "f", "added")], "strict", allow_additive=True)["is_valid"]
    df = spark.createDataFrame([("a", "f", "removed")], "t string, field string, change string")
    blocked = drift.drift_severity(df, df, "t", "strict")
    with pytest.raises(drift.SchemaDriftError):
        drift.require_no_drift(blocked, "t")
    assert drift.compare_contracts({"a": "int", "b": "int"}, {"b": "string", "c": "int"}) == {"added": ["c"], "removed": ["a"], "type_changed": ["b"]}


def test_key_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    row = quality.key_uniqueness(df, ["k"]).first()
    assert (row["duplicate_rows"], row["null_key_rows"]) == (1, 1)
    with pytest.raises(quality.QualityGateError):
        quality.require_unique(df, ["k"], "t")
    quality.require_unique(df.distinct(), ["k"], "t")


def test_volume_statuses(spark):
    rows = [("t", f"2020-01-0{d}", n) for d, n in ((1, 10), (2, 10), (3, 4), (4, 0), (5, 9))]
    counts = spark.createDataFrame(rows, "t string, day string, n int").withColumn("day", F.col("day").cast("date"))
    got = [r["status"] for r in quality.volume_anomalies(counts, "t", "day", "n").orderBy("day").collect()]
    assert got == ["PASS", "PASS", "WARN", "FAIL", "PASS"]


def test_freshness_limits(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    for now, want in (("2020-01-01 00:30:00", "PASS"), ("2020-01-01 00:30:01", "WARN"), ("2020-01-01 02:00:01", "ERROR")):
        assert quality.freshness(df, "ts", at(now)).first()["status"] == want


def test_hub_rows_with_null_parts_and_spellings(spark):
    load = F.lit("2020-01-01").cast("timestamp")
    rows = spark.createDataFrame([(1, None), (None, 1), (2, 3), (2, 3)], "a int, b int")
    found = vault.hub_rows(rows, ["a", "b"], "h", load, "s").collect()
    assert len(found) == len({r["h"] for r in found}) == 2
    text = spark.createDataFrame([("b ",), ("B",), ("b",)], "k string").repartition(3)
    assert [r["k"] for r in vault.hub_rows(text, ["k"], "h", load, "s").collect()] == ["B"]


def test_read_since_without_a_time_column_reads_all(spark):
    frame = spark.createDataFrame([(1,), (2,)], "id int")
    assert vault.read_since(frame, F.lit("2020-01-01").cast("timestamp")).count() == 2


def test_random_keys_are_long_and_distinct(spark):
    keys = spark.range(1000).select(F.when(F.col("id") > 3, F.col("id")).alias("subject_id")).select(privacy.random_key().alias("k")).collect()
    assert {len(r["k"]) for r in keys} == {32} and len({bytes(r["k"]) for r in keys}) == 1000


def test_equality_shuffles_once(spark):
    from tidemark.operators.assertions import tables

    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i int, s string")
    found = tables.equality(a, b)
    assert sorted(map(tuple, found.collect())) == [(2, "x", "a_minus_b"), (3, "y", "b_minus_a")]
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


def test_references_are_found_without_a_list(spark):
    """Contained columns of unique parents, also where a few values meet a large parent; nothing that one value breaks."""
    parent = spark.range(100_000).selectExpr("id * 7 AS id", "concat('n', id) AS name")
    child = spark.range(20_000).selectExpr("id AS own", "id * 7 AS whole", "IF(id = 3, -1, id * 7) AS broken", "id % 5 * 7 AS few", "id % 3 AS other", "cast(null AS bigint) AS nothing")
    got = {tuple(r) for r in vault.find_references({"p": parent, "c": child}).collect()}
    assert got == {("c", "whole", "p", "id", 20_000), ("c", "few", "p", "id", 5), ("c", "few", "c", "own", 5),
                   ("c", "few", "c", "whole", 5), ("c", "other", "c", "own", 3)}
    assert vault.find_references({"p": parent.limit(0)}).isEmpty()


def test_packed_hashes_come_back_and_order_as_texts(spark):
    texts = ["a" * 64, "0f" * 32, "A" * 64, "f" * 63, "f" * 65, "x", "", "é" * 32, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", unpacked(packed("t")).alias("u"), F.length(packed("t")).alias("n")).collect()
    assert all(r["t"] == r["u"] for r in rows) and sorted(r["n"] for r in rows if r["n"] is not None)[:2] == [32, 32]
    assert df.select(packed("t").alias("p")).distinct().count() == len(texts)


def test_text_links_shuffle_key_texts_and_keep_one_row_per_hash(spark):
    """Spellings, nulls and separators in the parts: one row for each hash, with the hashes of its own parts."""
    rows = [("a ", "b"), ("A", "B"), ("a||b", None), ("a|", "c"), (None, "b"), ("b", None), ("", "b"), ("x", "y||z"), (None, None)]
    src = spark.createDataFrame(rows, "a string, b string")
    found = vault.link_rows(src, {"a_hk": "a", "b_hk": "b"}, "lk", at("2020-01-01"), "s")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan[plan.index("Aggregate"):]
    assert "sha2" not in aggregate  # hashes are made after the shuffle
    own = src.select(business_hash(["a", "b"]).alias("lk"), business_hash(["a"]).alias("a_hk"), business_hash(["b"]).alias("b_hk")).collect()
    got = [(r["lk"], r["a_hk"], r["b_hk"]) for r in found.collect()]
    assert set(got) <= {tuple(r) for r in own} and len(got) == len({r["lk"] for r in own}) == len({g[0] for g in got})


def test_daily_snapshots_shuffle_diff_hashes_only_where_asked(spark):
    hub = spark.createDataFrame([("a",), ("b",)], "hk string")
    stored = sat(spark, [("a", "2020-01-01", "A"), ("a", "2020-01-03", "B")])
    day = lambda text: F.lit(text).cast("date")
    daily = snapshots.point_in_time_daily(hub, "hk", {"s": stored}, day("2020-01-01"), day("2020-01-03"))
    assert [r["s_diff_hk"] for r in daily.filter("hk = 'a'").orderBy("snapshot_date").collect()] == [
        r[0] for r in spark.sql("SELECT sha2(v, 256) FROM VALUES (1, 'A'), (2, 'A'), (3, 'B') t(i, v) ORDER BY i").collect()]
    dates = daily.select("hk", "snapshot_date", "s_load_date")._jdf.queryExecution().optimizedPlan().toString()
    assert "diff_hk" not in dates.split("Aggregate")[0]


def test_profile_counts_whole_events_before_it_explodes_them(spark):
    df = spark.createDataFrame([("t", '{"a":1,"b":"x"}')] * 50 + [("t", '{"a":2}')] * 5, "t string, j string")
    profile = drift.field_profile(df, F.col("j"), "t")
    assert {(r["field"], r["json_type"]): r["n_events"] for r in profile.collect()} == {("a", "number"): 55, ("b", "string"): 50}
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")
