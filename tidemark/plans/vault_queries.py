"""Queries: hash keys, hubs, links, satellites, snapshots, bridges, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.hashing import business_hash, diff_hash, surrogate_key
from tidemark.operators import snapshots, vault, vault_model
from tidemark.plans.registry import query
from tidemark.plans.shop import FIRST_LOAD, SECOND_LOAD, Shop, Vault, hk, load_time, with_tables
from tidemark.session import Tables, scratch_path
from tidemark.sources.sinks import append_counted


@query("vault_hash_key", """
SELECT c_custkey, sha256(upper(trim(c_name)) || '||' || upper(trim(c_mktsegment))) AS customer_hk FROM customer""")
def vault_hash_key(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", business_hash(["c_name", "c_mktsegment"]).alias("customer_hk"))


@query("vault_diff_hash", """
SELECT o_orderkey, sha256(o_orderpriority || '||' || coalesce(nullif(o_orderstatus, 'O'), 'NULL')) AS diff_hk FROM orders""")
def vault_diff_hash(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("O")))
    return rows.select("o_orderkey", diff_hash(["o_orderpriority", "status"]).alias("diff_hk"))


@query("vault_surrogate_key", """
SELECT c_custkey, md5(c_name || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '_dbt_utils_surrogate_key_null_')) AS surrogate FROM customer""")
def vault_surrogate_key(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return rows.select("c_custkey", surrogate_key(["c_name", "segment"]).alias("surrogate"))


HUBS = {
    "customer": "customer_id", "film": "film_id", "staff": "staff_id", "inventory": "inventory_id", "rental": "rental_id",
    "payment": "payment_id", "store": "store_id", "category": "category_id", "address": "address_id", "city": "city_id",
    "country": "country_id", "actor": "actor_id",
}


@query("vault_load_hub", with_tables("s_customer", f"""
SELECT {hk('customer_id')} AS customer_hk, customer_id,
  CASE WHEN active THEN '{FIRST_LOAD}' ELSE '{SECOND_LOAD}' END AS load_date, 'customer' AS record_source FROM s_customer"""))
def vault_load_hub(t: Tables) -> DataFrame:
    """Insert-only: keys loaded first keep their first load date."""
    shop = Shop(t)
    early = vault.hub_rows(shop.customer.filter("active"), ["customer_id"], "customer_hk", load_time(FIRST_LOAD), "customer")
    late = vault.hub_rows(shop.customer, ["customer_id"], "customer_hk", load_time(SECOND_LOAD), "customer")
    return vault.load_hub(early, late, "customer_hk")


@query("vault_load_all_hubs", """
WITH items AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem), rents AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem)
SELECT 'customer' AS hub, count(*) AS n_keys FROM customer UNION ALL SELECT 'film', count(*) FROM part
UNION ALL SELECT 'staff', count(*) FROM supplier UNION ALL SELECT 'actor', count(*) FROM supplier
UNION ALL SELECT 'inventory', count(*) FROM items UNION ALL SELECT 'rental', count(*) FROM rents
UNION ALL SELECT 'payment', count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice)) FROM lineitem
UNION ALL SELECT 'store', count(DISTINCT s_nationkey) FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL SELECT 'category', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'address', count(*) FROM nation
UNION ALL SELECT 'city', count(*) FROM nation UNION ALL SELECT 'country', count(*) FROM region""")
def vault_load_all_hubs(t: Tables) -> DataFrame:
    """Every hub of the model from one configuration."""
    v = Vault(t)
    counts = [
        v.hub(table, key).agg(F.count(F.lit(1)).alias("n_keys")).select(F.lit(table).alias("hub"), "n_keys")
        for table, key in HUBS.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


@query("vault_load_hub_overwrite", with_tables("s_customer", f"""
SELECT {hk('customer_id')} AS customer_hk, customer_id,
  CASE WHEN active THEN '{SECOND_LOAD}' ELSE '{FIRST_LOAD}' END AS load_date FROM s_customer"""))
def vault_load_hub_overwrite(t: Tables) -> DataFrame:
    shop = Shop(t)
    stored = vault.hub_rows(shop.customer, ["customer_id"], "customer_hk", load_time(FIRST_LOAD), "customer")
    again = vault.hub_rows(shop.customer.filter("active"), ["customer_id"], "customer_hk", load_time(SECOND_LOAD), "customer")
    return vault.load_hub(stored, again, "customer_hk", keep_first_load_date=False).drop("record_source")


@query("vault_load_link", with_tables("s_film_actor", f"""
SELECT sha256(film_id || '||' || actor_id) AS film_actor_hk, {hk('film_id')} AS film_hk, {hk('actor_id')} AS actor_hk FROM s_film_actor"""))
def vault_load_link(t: Tables) -> DataFrame:
    v = Vault(t)
    rows = v.link("film_actor", "film_actor_hk", film_hk="film_id", actor_hk="actor_id")
    stored = vault.link_rows(
        Shop(t).film_actor.filter("film_id < actor_id"), {"film_hk": "film_id", "actor_hk": "actor_id"},
        "film_actor_hk", load_time(FIRST_LOAD), "film_actor",
    )
    return vault.load_link(stored, rows, "film_actor_hk").select("film_actor_hk", "film_hk", "actor_hk")


@query("vault_load_link_three_hubs", with_tables("s_rental", f"""
SELECT sha256(customer_id || '||' || inventory_id || '||' || staff_id) AS rental_hk, {hk('customer_id')} AS customer_hk,
  {hk('inventory_id')} AS inventory_hk, {hk('staff_id')} AS staff_hk FROM s_rental GROUP BY customer_id, inventory_id, staff_id"""))
def vault_load_link_three_hubs(t: Tables) -> DataFrame:
    return Vault(t).link(
        "rental", "rental_hk", customer_hk="customer_id", inventory_hk="inventory_id", staff_hk="staff_id"
    ).select("rental_hk", "customer_hk", "inventory_hk", "staff_hk")


@query("vault_load_link_nested_hash", with_tables("s_film_actor", """
SELECT sha256(sha256(film_id::VARCHAR) || '|' || sha256(actor_id::VARCHAR)) AS film_actor_hk,
  sha256(film_id::VARCHAR) AS film_hk, sha256(actor_id::VARCHAR) AS actor_hk FROM s_film_actor"""))
def vault_load_link_nested_hash(t: Tables) -> DataFrame:
    return vault.link_rows(
        Shop(t).film_actor, {"film_hk": "film_id", "actor_hk": "actor_id"}, "film_actor_hk",
        load_time(FIRST_LOAD), "film_actor", nested=True,
    ).select("film_actor_hk", "film_hk", "actor_hk")


# Payments in two versions; the third load returns flag R payments to their first amount.
@query("vault_satellite_changed", with_tables("s_payment", f"""
SELECT {hk('payment_id')} AS payment_hk, CAST(amount AS DOUBLE) AS amount FROM s_payment WHERE flag = 'R' AND discount > 0"""))
def vault_satellite_changed(t: Tables) -> DataFrame:
    """Compared with the latest version only, so a return to an earlier value is a new version."""
    v = Vault(t)
    first = v.shop.payment.withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    again = v.satellite("payment", "payment_id", ["amount"], first, "2002-03-01 00:00:00")
    return vault.changed_versions(v.sat_payment_pricing, again, "payment_hk").select("payment_hk", "amount")


@query("vault_satellite_unseen", with_tables("s_payment", f"""
SELECT {hk('payment_id')} AS payment_hk, CAST(amount + 1 AS DOUBLE) AS amount FROM s_payment WHERE flag = 'A'"""))
def vault_satellite_unseen(t: Tables) -> DataFrame:
    """Compared with all history: only attribute values never stored before are new."""
    v = Vault(t)
    rows = v.shop.payment.withColumn("amount", F.when(F.col("flag") == "A", F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,4)"))
    again = v.satellite("payment", "payment_id", ["amount"], rows, "2002-03-01 00:00:00")
    return vault.unseen_versions(v.sat_payment_pricing, again, "payment_hk").select("payment_hk", "amount")


@query("vault_missing_columns", with_tables("s_film", f"""
SELECT {hk('film_id')} AS film_hk, title, CAST(NULL AS VARCHAR) AS fulltext, sha256(title || '||NULL') AS diff_hk FROM s_film"""))
def vault_missing_columns(t: Tables) -> DataFrame:
    return Vault(t).satellite("film", "film_id", ["title", "fulltext"]).select("film_hk", "title", "fulltext", "diff_hk")


@query("vault_read_since", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'""")
def vault_read_since(t: Tables) -> DataFrame:
    return vault.read_since(t.orders, F.lit("2000-06-01").cast("timestamp_ntz"), "o_orderdate").select("o_orderkey", "o_orderstatus")


@query("vault_current_versions", with_tables("s_payment", f"""
SELECT {hk('payment_id')} AS payment_hk, CASE WHEN flag = 'R' THEN '{SECOND_LOAD}' ELSE '{FIRST_LOAD}' END AS load_date,
  CAST(CASE WHEN flag = 'R' THEN amount * (1 - discount) ELSE amount END AS DOUBLE) AS amount FROM s_payment"""))
def vault_current_versions(t: Tables) -> DataFrame:
    return vault.current_versions(Vault(t).sat_payment_pricing, "payment_hk").select("payment_hk", "load_date", "amount")


PIT_COMMON = f"""
sat AS (SELECT {hk('payment_id')} AS hk, TIMESTAMP '{FIRST_LOAD}' AS load_date, sha256(CAST(CAST(amount AS DECIMAL(18,4)) AS VARCHAR)) AS diff_hk FROM s_payment
  UNION ALL SELECT {hk('payment_id')}, TIMESTAMP '{SECOND_LOAD}', sha256(CAST(CAST(amount * (1 - discount) AS DECIMAL(18,4)) AS VARCHAR)) FROM s_payment WHERE flag = 'R')"""


@query("vault_point_in_time", f"WITH s_payment AS ({with_tables('s_payment', 'SELECT * FROM s_payment')}), {PIT_COMMON}" + f"""
SELECT p.hk AS payment_hk, '2002-02-01' AS snapshot_date, CAST(s.load_date AS VARCHAR) AS pricing_load_date, s.diff_hk AS pricing_diff_hk,
  '{FIRST_LOAD}' AS core_load_date
FROM (SELECT DISTINCT hk FROM sat) p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY hk ORDER BY load_date DESC) AS rn FROM sat WHERE CAST(load_date AS DATE) <= DATE '2002-02-01') s
  ON s.hk = p.hk AND s.rn = 1""")
def vault_point_in_time(t: Tables) -> DataFrame:
    v = Vault(t, payment=("amount", "discount", "flag", "payment_date"))
    pit = snapshots.point_in_time(
        v.hub("payment", "payment_id"), "payment_hk",
        {"pricing": v.sat_payment_pricing, "core": v.sat_payment_core, "absent": None},
        F.lit("2002-02-01").cast("date"), in_place=True,
    )
    return pit.filter("absent_load_date is null").select(
        "payment_hk", "snapshot_date", "pricing_load_date", "pricing_diff_hk", "core_load_date"
    )


def _daily_sql(table: str, key: str, second: str, versions: str, hk_name: str) -> str:
    return with_tables(f"s_{table}", f""", sat AS ({versions}),
days AS (SELECT unnest(generate_series(DATE '2001-12-31', DATE '2002-02-04', INTERVAL 1 DAY))::DATE AS d),
spine AS (SELECT DISTINCT {hk(key)} AS hk FROM s_{table})
SELECT hk AS {hk_name}, CAST(d AS VARCHAR) AS snapshot_date, CAST(max(load_date) AS VARCHAR) AS {second}_load_date
FROM (SELECT spine.hk, days.d FROM spine, days) g LEFT JOIN sat ON sat.k = g.hk AND sat.load_date <= g.d GROUP BY hk, d""")


@query("vault_pit_daily_customer", _daily_sql("customer", "customer_id", "core", f"""
SELECT {hk('customer_id')} AS k, TIMESTAMP '{FIRST_LOAD}' AS load_date FROM s_customer UNION ALL
SELECT {hk('customer_id')}, TIMESTAMP '{SECOND_LOAD}' FROM s_customer WHERE NOT active""", "customer_hk"))
def vault_pit_daily_customer(t: Tables) -> DataFrame:
    v = Vault(t)
    return snapshots.point_in_time_daily(
        v.hub("customer", "customer_id"), "customer_hk", {"core": v.sat_customer},
        F.lit("2001-12-31").cast("date"), F.lit("2002-02-04").cast("date"),
    ).select("customer_hk", "snapshot_date", "core_load_date")


@query("vault_pit_daily_film", with_tables("s_film", f""",
days AS (SELECT unnest(generate_series(DATE '2001-12-31', DATE '2002-01-04', INTERVAL 1 DAY))::DATE AS d)
SELECT {hk('film_id')} AS film_hk, CAST(d AS VARCHAR) AS snapshot_date,
  CASE WHEN d > DATE '2002-01-01' THEN '{FIRST_LOAD}' END AS core_load_date,
  CASE WHEN d > DATE '2002-01-01' THEN '{FIRST_LOAD}' END AS pricing_load_date FROM s_film, days"""))
def vault_pit_daily_film(t: Tables) -> DataFrame:
    v = Vault(t)
    return snapshots.point_in_time_daily(
        v.hub("film", "film_id"), "film_hk", {"core": v.sat_film, "pricing": v.sat_film_pricing},
        F.lit("2001-12-31").cast("date"), F.lit("2002-01-04").cast("date"),
    ).select("film_hk", "snapshot_date", "core_load_date", "pricing_load_date")


@query("vault_pit_daily_payment", with_tables("s_payment", f""",
days AS (SELECT unnest(generate_series(DATE '2002-01-30', DATE '2002-02-03', INTERVAL 1 DAY))::DATE AS d)
SELECT {hk('payment_id')} AS payment_hk, CAST(d AS VARCHAR) AS snapshot_date, '{FIRST_LOAD}' AS core_load_date,
  CASE WHEN d > DATE '2002-02-01' AND flag = 'R' THEN '{SECOND_LOAD}' ELSE '{FIRST_LOAD}' END AS pricing_load_date FROM s_payment, days"""))
def vault_pit_daily_payment(t: Tables) -> DataFrame:
    v = Vault(t, payment=("amount", "discount", "flag", "payment_date"))
    return snapshots.point_in_time_daily(
        v.hub("payment", "payment_id"), "payment_hk", {"core": v.sat_payment_core, "pricing": v.sat_payment_pricing},
        F.lit("2002-01-30").cast("date"), F.lit("2002-02-03").cast("date"), in_place=True,
    ).select("payment_hk", "snapshot_date", "core_load_date", "pricing_load_date")


@query("vault_pit_daily_rental", with_tables("s_rental", f""",
days AS (SELECT unnest(generate_series(DATE '2002-01-01', DATE '2002-01-03', INTERVAL 1 DAY))::DATE AS d)
SELECT {hk('rental_id')} AS rental_hk, CAST(d AS VARCHAR) AS snapshot_date, '{FIRST_LOAD}' AS core_load_date FROM s_rental, days"""))
def vault_pit_daily_rental(t: Tables) -> DataFrame:
    """The inclusive form: a version loaded during the snapshot day counts for that day."""
    v = Vault(t)
    return snapshots.point_in_time_daily(
        v.hub("rental", "rental_id"), "rental_hk", {"core": v.sat_rental},
        F.lit("2002-01-01").cast("date"), F.lit("2002-01-03").cast("date"), spine_day_inclusive=True,
    ).select("rental_hk", "snapshot_date", "core_load_date")


@query("vault_bridge_path", with_tables("s_rental s_inventory", f"""
SELECT {hk('r.rental_id')} AS rental_hk, {hk('r.inventory_id')} AS inventory_hk, {hk('i.film_id')} AS film_hk
FROM s_rental r JOIN s_inventory i ON i.inventory_id = r.inventory_id"""))
def vault_bridge_path(t: Tables) -> DataFrame:
    v = Vault(t, rental=("inventory_id",), inventory=("film_id",))
    return snapshots.bridge(
        [(v.hub("rental", "rental_id"), "rental_hk"), (v.hub("inventory", "inventory_id"), "inventory_hk"), (v.hub("film", "film_id"), "film_hk")],
        [
            (v.link("rental", "rental_inventory_hk", keep_text=True, rental_hk="rental_id", inventory_hk="inventory_id"), "rental_inventory_hk"),
            (v.link("inventory", "inventory_film_hk", keep_text=True, inventory_hk="inventory_id", film_hk="film_id"), "inventory_film_hk"),
        ],
    )


@query("vault_bridge_film_cast", with_tables("s_film_actor", f"""
SELECT {hk('film_id')} AS film_hk, sha256(film_id || '||' || actor_id) AS film_actor_hk, {hk('actor_id')} AS actor_hk FROM s_film_actor"""))
def vault_bridge_film_cast(t: Tables) -> DataFrame:
    v = Vault(t)
    return snapshots.bridge(
        [(v.hub("film", "film_id"), "film_hk"), (v.hub("actor", "actor_id"), "actor_hk")],
        [(v.link("film_actor", "film_actor_hk", film_hk="film_id", actor_hk="actor_id"), "film_actor_hk")],
        keep_link_keys=True,
    )


@query("vault_bridge_rental_film", with_tables("s_rental s_inventory", f"""
SELECT {hk('r.rental_id')} AS rental_hk, sha256(r.rental_id || '||' || r.inventory_id) AS rental_inventory_hk,
  {hk('r.inventory_id')} AS inventory_hk, sha256(i.inventory_id || '||' || i.film_id) AS inventory_film_hk, {hk('i.film_id')} AS film_hk
FROM s_rental r JOIN s_inventory i ON i.inventory_id = r.inventory_id"""))
def vault_bridge_rental_film(t: Tables) -> DataFrame:
    v = Vault(t, rental=("inventory_id",), inventory=("film_id",))
    return snapshots.bridge(
        [(v.hub("rental", "rental_id"), "rental_hk"), (v.hub("inventory", "inventory_id"), "inventory_hk"), (v.hub("film", "film_id"), "film_hk")],
        [
            (v.link("rental", "rental_inventory_hk", keep_text=True, rental_hk="rental_id", inventory_hk="inventory_id"), "rental_inventory_hk"),
            (v.link("inventory", "inventory_film_hk", keep_text=True, inventory_hk="inventory_id", film_hk="film_id"), "inventory_film_hk"),
        ],
        keep_link_keys=True,
    )


@query("vault_key_history", with_tables("s_customer", f"""
SELECT {hk('customer_id')} AS customer_hk, '{FIRST_LOAD}' AS load_date, segment FROM s_customer
UNION ALL SELECT {hk('customer_id')}, '{SECOND_LOAD}', 'CLOSED' FROM s_customer WHERE NOT active"""))
def vault_key_history(t: Tables) -> DataFrame:
    return vault.key_history(Vault(t).sat_customer, "customer_hk").select("customer_hk", "load_date", "segment")


@query("vault_hub_integrity", with_tables("s_customer", f"""
SELECT {hk('customer_id')} AS customer_hk, CAST(2 AS BIGINT) AS n_rows FROM s_customer WHERE NOT active"""))
def vault_hub_integrity(t: Tables) -> DataFrame:
    """A hub into which inactive customers were appended twice."""
    v = Vault(t)
    again = vault.hub_rows(v.shop.customer.filter("not active"), ["customer_id"], "customer_hk", load_time(SECOND_LOAD), "customer")
    return vault.duplicate_hashes(v.hub("customer", "customer_id").unionByName(again), "customer_hk")


@query("vault_link_integrity", with_tables("s_rental s_customer", f"""
SELECT sha256(r.rental_id || '||' || r.customer_id) AS rental_customer_hk, 'customer_hk' AS reference, {hk('r.customer_id')} AS hub_hash
FROM s_rental r JOIN s_customer c ON c.customer_id = r.customer_id WHERE NOT c.active"""))
def vault_link_integrity(t: Tables) -> DataFrame:
    """Links to customers whose hub row is missing because only active ones were loaded."""
    v = Vault(t)
    partial = vault.hub_rows(v.shop.customer.filter("active"), ["customer_id"], "customer_hk", load_time(FIRST_LOAD), "customer")
    link = v.link("rental", "rental_customer_hk", rental_hk="rental_id", customer_hk="customer_id")
    return vault.missing_parents(link, "rental_customer_hk", {"rental_hk": v.hub("rental", "rental_id"), "customer_hk": partial})


@query("vault_satellite_integrity", with_tables("s_customer", f"""
SELECT {hk('customer_id')} AS customer_hk, CAST(2 AS BIGINT) AS n_versions FROM s_customer WHERE NOT active"""))
def vault_satellite_integrity(t: Tables) -> DataFrame:
    v = Vault(t)
    partial = vault.hub_rows(v.shop.customer.filter("active"), ["customer_id"], "customer_hk", load_time(FIRST_LOAD), "customer")
    return vault.orphan_versions(v.sat_customer, partial, "customer_hk")


@query("vault_load_log", with_tables("s_film_actor s_customer", """
SELECT 'hub_customer' AS table_name, 'hub' AS table_type, count(*) AS row_count, 'PASS' AS status FROM customer
UNION ALL SELECT 'brg_film_cast', 'bridge', count(*), 'PASS' FROM s_film_actor
UNION ALL SELECT 'pit_customer', 'pit', count(*) * 3, 'PASS' FROM s_customer
UNION ALL SELECT 'sat_customer', 'satellite', CAST(count(*) + count_if(NOT active) AS BIGINT), 'PASS' FROM s_customer"""))
def vault_load_log(t: Tables) -> DataFrame:
    v = Vault(t)
    hub = v.hub("customer", "customer_id")
    pit = snapshots.point_in_time_daily(
        hub, "customer_hk", {"core": v.sat_customer}, F.lit("2002-01-01").cast("date"), F.lit("2002-01-03").cast("date")
    )
    return vault.load_log(
        {
            "hub_customer": ("hub", hub),
            "sat_customer": ("satellite", v.sat_customer),
            "pit_customer": ("pit", pit),
            "brg_film_cast": ("bridge", vault_bridge_film_cast(t)),
        },
        load_time(FIRST_LOAD),
    ).drop("loaded_at")


@query("vault_suggest_entities", """
SELECT 'customer' AS table_name, '' AS column_name, '' AS parent, 'hub' AS suggestion
UNION ALL SELECT 'orders', '', '', 'hub' UNION ALL SELECT 'part', '', '', 'hub' UNION ALL SELECT 'supplier', '', '', 'hub'
UNION ALL SELECT 'lineitem', '', '', 'junction'
UNION ALL SELECT 'orders', 'o_custkey', 'customer', 'link' WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'lineitem', 'l_orderkey', 'orders', 'link' WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'lineitem', 'l_partkey', 'part', 'link' WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'lineitem', 'l_suppkey', 'supplier', 'link' WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'customer', 'c_custkey', 'orders', 'link' WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def vault_suggest_entities(t: Tables) -> DataFrame:
    tables = {n: getattr(t, n) for n in ("customer", "orders", "lineitem", "part", "supplier")}
    return vault.suggest_entities(
        tables,
        {
            "customer": ["c_custkey", "c_nationkey"], "orders": ["o_orderkey", "o_custkey"], "part": ["p_partkey"],
            "supplier": ["s_suppkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        },
        [
            ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("customer", "c_custkey", "orders", "o_custkey"),
        ],
    )


# Integer and text columns of the tables that references are looked for in.
COLUMNS = {
    "customer": (("c_custkey", "c_nationkey"), ("c_name", "c_mktsegment")), "supplier": (("s_suppkey", "s_nationkey"), ("s_name",)),
    "nation": (("n_nationkey", "n_regionkey"), ("n_name",)), "region": (("r_regionkey",), ("r_name",)),
    "orders": (("o_orderkey", "o_custkey"), ("o_orderstatus", "o_orderpriority")),
}


def references_sql() -> str:
    """Every column against every other of its kind, exactly."""
    parts = []
    for kind in (0, 1):
        every = [(t, c) for t, kinds in COLUMNS.items() for c in kinds[kind]]
        for t, c in every:
            parts += [f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS parent, '{k}' AS parent_column, count(DISTINCT {c}) AS n_values FROM {t}
HAVING count({c}) > 0 AND (SELECT count(*) = count(DISTINCT {k}) FROM {p}) AND NOT EXISTS (SELECT {c} FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL))"""
                      for p, k in every if (p, k) != (t, c)]
    return " UNION ALL ".join(parts)


@query("vault_find_references", references_sql())
def vault_find_references(t: Tables) -> DataFrame:
    """References among five tables, found from their columns' sketches and checked exactly."""
    return vault.find_references({name: getattr(t, name).select(*kinds[0], *kinds[1]) for name, kinds in COLUMNS.items()})


@query("vault_typed_satellite", with_tables("s_film", f"""
SELECT {hk('film_id')} AS film_hk, CAST(length AS BIGINT) AS length, TRY_CAST(title AS INTEGER) IS NULL AS title_unreadable,
  CAST(rental_rate AS DOUBLE) AS rental_rate FROM s_film"""))
def vault_typed_satellite(t: Tables) -> DataFrame:
    text = Shop(t).film.select("film_id", *[F.col(c).cast("string").alias(c) for c in ("length", "title", "rental_rate")])
    types = {"length": "bigint", "title": "int", "rental_rate": "decimal(4,2)"}
    return vault.satellite_rows(text, "film_id", "film_hk", list(types), load_time(FIRST_LOAD), "film", types).select(
        "film_hk", "length", F.col("title").isNull().alias("title_unreadable"), "rental_rate"
    )


MODEL = {
    "hubs": [
        {"name": f"HUB_{table.upper()}", "source_table": table, "business_key_columns": [f"{table}_id"], "record_source": table}
        for table in ("customer", "film", "inventory", "rental")
    ] + [{"name": "HUB_STAFF", "source_table": "staff", "business_key_columns": ["staff_id"], "record_source": "staff", "enabled": False}],
    "links": [
        {"name": "LNK_RENTAL_CUSTOMER", "source_table": "rental", "record_source": "rental", "hub_references": [
            {"hub": "HUB_RENTAL", "source_column": "rental_id"}, {"hub": "HUB_CUSTOMER", "source_column": "customer_id"}]},
        {"name": "LNK_RENTAL_INVENTORY", "source_table": "rental", "record_source": "rental", "hub_references": [
            {"hub": "HUB_RENTAL", "source_column": "rental_id"}, {"hub": "HUB_INVENTORY", "source_column": "inventory_id"}]},
        {"name": "LNK_INVENTORY_FILM", "source_table": "inventory", "record_source": "inventory", "hub_references": [
            {"hub": "HUB_INVENTORY", "source_column": "inventory_id"}, {"hub": "HUB_FILM", "source_column": "film_id"}]},
    ],
    "satellites": [
        {"name": "SAT_CUSTOMER_CORE", "source_table": "customer", "parent_hub": "HUB_CUSTOMER", "hub_key_source_column": "customer_id",
         "tracked_columns": ["first_name", "last_name", "segment", "fax"], "record_source": "customer"},
        {"name": "SAT_FILM_PRICING", "source_table": "film", "parent_hub": "HUB_FILM", "hub_key_source_column": "film_id",
         "tracked_columns": ["rental_rate", "replacement_cost"], "record_source": "film"},
    ],
    "pit_tables": [{"name": "PIT_FILM", "hub": "HUB_FILM", "satellites": ["SAT_FILM_PRICING", "SAT_FILM_TEXT"]}],
    "bridge_tables": [{"name": "BRG_RENTAL_FILM", "path": ["HUB_RENTAL", "LNK_RENTAL_INVENTORY", "HUB_INVENTORY", "LNK_INVENTORY_FILM", "HUB_FILM"]}],
}


@query("vault_from_configuration", with_tables("s_rental s_inventory", """
SELECT 'HUB_CUSTOMER' AS table_name, count(*) AS n_first, CAST(0 AS BIGINT) AS n_second FROM customer UNION ALL SELECT 'HUB_FILM', count(*), 0 FROM part
UNION ALL SELECT 'HUB_INVENTORY', count(*), 0 FROM s_inventory UNION ALL SELECT 'HUB_RENTAL', count(*), 0 FROM s_rental
UNION ALL SELECT 'LNK_RENTAL_CUSTOMER', count(*), 0 FROM s_rental UNION ALL SELECT 'LNK_RENTAL_INVENTORY', count(*), 0 FROM s_rental
UNION ALL SELECT 'LNK_INVENTORY_FILM', count(*), 0 FROM s_inventory
UNION ALL SELECT 'SAT_CUSTOMER_CORE', count(*), CAST(count_if(c_acctbal < 0) AS BIGINT) FROM customer UNION ALL SELECT 'SAT_FILM_PRICING', count(*), 0 FROM part
UNION ALL SELECT 'PIT_FILM', count(*), count(*) FROM part UNION ALL SELECT 'BRG_RENTAL_FILM', count(*), count(*) FROM s_rental"""))
def vault_from_configuration(t: Tables) -> DataFrame:
    """The whole model loaded twice; in between, inactive customers changed their segment."""
    shop, base, written, log = Shop(t), scratch_path(t.spark, "vault"), set(), []
    moved = shop.customer.withColumn("segment", F.when(F.col("active"), F.col("segment")).otherwise("CLOSED"))

    def stored(name: str) -> DataFrame | None:
        return t.spark.read.parquet(f"{base}/{name}") if name in written else None

    for run, at_time in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        source = lambda table, run=run: moved if run == 2 and table == "customer" else getattr(shop, table)
        for load in (vault_model.hub_loads, vault_model.link_loads, vault_model.satellite_loads):
            for name, rows in load(MODEL, source, stored, load_time(at_time)).items():
                log.append((name, run, append_counted(rows, f"{base}/{name}")))
                written.add(name)
        derived = vault_model.snapshot_tables(MODEL, stored, F.lit("2002-03-01").cast("date"))
        derived |= vault_model.bridge_tables(MODEL, stored)
        for name, rows in derived.items():
            log.append((name, run, append_counted(rows, f"{base}/{name}-{run}")))
    counts = t.spark.createDataFrame(log, "table_name string, run int, n bigint")
    return counts.groupBy("table_name").agg(
        F.sum(F.when(F.col("run") == 1, F.col("n"))).alias("n_first"), F.sum(F.when(F.col("run") == 2, F.col("n"))).alias("n_second")
    )
