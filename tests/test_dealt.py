"""Rows dealt by a hash that doesn't travel: the same rows as otherwise, and no shuffle of hashes."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshots, vault
from tidemark.plans import load_queries
from tidemark.plans.shop import Vault
from tidemark.session import Tables
from tests.test_plans import PATH, plan


def at():
    return F.lit("2002-01-01").cast("timestamp_ntz")


@pytest.fixture()
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(map(repr, df.collect()))


# parts that are null, empty, repeated, or hold the separator, so that different parts share a text
PAIRS = [
    ("a", "b"), (" A ", "b"), ("a", "c"), ("a||b", "c"), ("a", "b||c"), (None, "a||b"), ("a|", "b"), ("a", "|b"), (None, "a"), ("a", None),
    (None, None), ("", "a"), ("a", ""), ("b||c", None), ("c", "d"), ("c", "d"), ("|", "|"), ("a||b", None),
]


@pytest.mark.parametrize("by", ["x_hk", "y_hk"])
def test_links_in_place_are_the_same_links(unbroadcast, by):
    df = unbroadcast.createDataFrame([(*p, i) for i, p in enumerate(PAIRS)], "x string, y string, n int").repartition(5)
    references = {"x_hk": "x", "y_hk": "y"}
    usual = vault.link_rows(df, references, "l_hk", at(), "t")
    placed = vault.link_rows(vault.dealt(df, by[0]), references, "l_hk", at(), "t", dealt_by=by)
    assert rows(placed) == rows(usual.select(*placed.columns)) and usual.count() > 9
    hub = vault.hub_rows(vault.dealt(df, by[0]), [by[0]], by, at(), "t", vault.business_hash([by[0]]))
    assert rows(hub) == rows(vault.hub_rows(df, [by[0]], by, at(), "t"))
    assert rows(placed.join(hub.select(by), by)) == rows(usual.join(hub.select(by), by))


def test_a_bridge_by_text_is_the_same_bridge(unbroadcast):
    df = unbroadcast.createDataFrame(PAIRS, "x string, y string").repartition(4)
    onward = df.select(F.col("y"), F.col("x").alias("z"))

    def walk(keep, **how):
        source = (lambda d, k: vault.dealt(d, k)) if how else (lambda d, k: d)
        hubs = [(vault.hub_rows(source(d, k), [k], f"{k}_hk", at(), "t", vault.business_hash([k]) if how else None), f"{k}_hk")
                for d, k in ((df, "x"), (onward, "y"), (onward, "z"))]
        links = [(vault.link_rows(source(d, a), {f"{a}_hk": a, f"{b}_hk": b}, f"{a}{b}_hk", at(), "t", **(how | {"dealt_by": f"{a}_hk"} if how else {})), f"{a}{b}_hk")
                 for d, a, b in ((df, "x", "y"), (onward, "y", "z"))]
        return snapshots.bridge(hubs, links, keep)

    for keep in (False, True):
        assert rows(walk(keep, keep_text=True)) == rows(walk(keep))


def test_payments_are_shuffled_once_for_a_snapshot(unbroadcast):
    """Hub and satellites read one shuffle, which carries no hash; their rows meet in place."""
    text = plan(load_queries()["vault_pit_daily_payment"].build(Tables(unbroadcast, PATH)))
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "orderkey" not in line]
    assert len(dealt) == 3 and all("payment_id" in line and "REPARTITION_BY_COL" in line for line in dealt)


def test_no_hash_travels_in_a_bridge(unbroadcast):
    """A hash column of a path would be shuffled by name; texts are shuffled by what is made of them."""
    frame = load_queries()["vault_bridge_rental_film"].build(Tables(unbroadcast, PATH))
    frame.collect()
    text = plan(frame).split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning(inventory_hk" not in text and "Exchange hashpartitioning(rental_hk" not in text


def test_versions_of_a_payment_meet_in_place(unbroadcast):
    v = Vault(Tables(unbroadcast, PATH), payment=("amount", "discount", "flag"))
    text = plan(vault.current_versions(v.sat_payment_pricing, "payment_hk", in_place=True))
    assert "hashpartitioning(payment_hk" not in text
    usual = vault.current_versions(Vault(Tables(unbroadcast, PATH)).sat_payment_pricing, "payment_hk")
    assert rows(vault.current_versions(v.sat_payment_pricing, "payment_hk", in_place=True)) == rows(usual)


def test_a_second_load_shuffles_what_its_hashes_are_made_of(unbroadcast):
    """Rows whose hash isn't stored, odd ones too, are found without shuffling rows of hashes, and are the same rows."""
    from tidemark.operators import vault_model
    from tidemark.operators.upsert import new_rows

    df = unbroadcast.createDataFrame(PAIRS, "x string, y string").repartition(3)
    model = {
        "hubs": [{"name": "HUB_X", "source_table": "t", "business_key_columns": ["x", "y"], "record_source": "t"}],
        "links": [{"name": "LNK_XY", "source_table": "t", "record_source": "t", "hub_references": [
            {"hub": "HUB_X", "source_column": "x"}, {"hub": "HUB_Y", "source_column": "y"}]}],
    }
    for load, name, key in ((vault_model.hub_loads, "HUB_X", "hk_x"), (vault_model.link_loads, "LNK_XY", "hk_xy")):
        full = load(model, lambda _: df, lambda _: None, at())[name]
        some = load(model, lambda _: df.filter("x is null or x > 'a'"), lambda _: None, at())[name]
        new = load(model, lambda _: df, lambda _, some=some: some, at())[name]
        assert new.columns == full.columns and 0 < new.count() < full.count()
        assert rows(new) == rows(new_rows(some, full, [key]).select(*full.columns))
        made = [line for line in plan(new).splitlines() if "Exchange hashpartitioning" in line and "REPARTITION_BY_COL" in line]
        assert made and all("sha2(" in line for line in made)


@pytest.mark.parametrize("name, hashes", [
    ("mart_customer_summary", ("rental_hk", "payment_hk")), ("mart_customer_summary_all_versions", ("rental_hk", "payment_hk")),
    ("mart_staff_performance", ("rental_hk", "payment_hk")), ("mart_inventory_status", ("rental_hk",)),
    ("mart_inventory_status_any_return", ("rental_hk",)), ("mart_film_popularity", ("payment_hk", "inventory_hk")),
    ("mart_revenue_by_store", ("payment_hk", "rental_hk")),
])
def test_rows_of_a_mart_meet_in_place(unbroadcast, monkeypatch, name, hashes):
    """No table is shuffled by these hashes; where rows go to another's hash, it is made of their text on the way."""
    from tidemark.operators import marts

    made = []
    monkeypatch.setattr(marts, "stored", lambda mart, _: made.append(mart) or mart)
    frame = load_queries()[name].build(Tables(unbroadcast, PATH))
    for df in made or [frame]:
        df.collect()
        text = plan(df).split("== Initial Plan ==")[0]
        assert "REPARTITION_BY_COL" in text and not [h for h in hashes if f"Exchange hashpartitioning({h}" in text]
