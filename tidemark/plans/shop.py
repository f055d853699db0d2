"""The rental-shop tables, derived from the star schema by Spark and, for oracles, by SQL.

customer = customer, staff and actor = supplier, film = part, store, address and city = nation,
country = region, category = part brand; an inventory item is a (part, supplier) pair in
lineitem, a rental is an (order, part, supplier) triple, and a payment is a lineitem row, keyed by
those with line number, ship date and price because the line number alone repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.hashing import business_hash
from tidemark.operators import vault
from tidemark.session import Tables, spread


def _dash(*columns: str) -> Column:
    return F.concat_ws("-", *[F.col(c) for c in columns])


class Shop:
    """Lazily derived current-state tables."""

    def __init__(self, t: Tables):
        self.t = t

    @property
    def customer(self) -> DataFrame:
        return self.t.customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("c_mktsegment").alias("segment"),
            (F.col("c_acctbal") >= 0).alias("active"),
            F.col("c_nationkey").alias("address_id"),
            F.col("c_nationkey").alias("store_id"),
        )

    @property
    def address(self) -> DataFrame:
        return self.t.nation.select(
            F.col("n_nationkey").alias("address_id"), F.col("n_name").alias("address"), F.col("n_nationkey").alias("city_id")
        )

    @property
    def city(self) -> DataFrame:
        return self.t.nation.select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
        )

    @property
    def country(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"))

    @property
    def staff(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("staff_id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
            (F.col("s_acctbal") >= 0).alias("active"),
            F.col("s_nationkey").alias("address_id"),
            F.col("s_nationkey").alias("store_id"),
        )

    @property
    def actor(self) -> DataFrame:
        return self.staff.select(F.col("staff_id").alias("actor_id"), "first_name", "last_name")

    @property
    def store(self) -> DataFrame:
        managers = self.t.supplier.groupBy(F.col("s_nationkey").alias("store_id")).agg(
            F.min("s_suppkey").alias("manager_staff_id")
        )
        return self.t.nation.select(F.col("n_nationkey").alias("store_id"), F.col("n_nationkey").alias("city_id")).join(
            managers, "store_id"
        )

    @property
    def film(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("film_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("rating"),
            F.col("p_size").alias("length"),
            F.col("p_size").alias("rental_duration"),
            (F.col("p_size") * F.lit(0.1)).cast("decimal(4,2)").alias("rental_rate"),
            (F.floor("p_retailprice") / 100).cast("decimal(5,2)").alias("replacement_cost"),
            F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")).cast("timestamp_ntz").alias("last_update"),
        )

    @property
    def category(self) -> DataFrame:
        return self.t.part.select(F.col("p_brand").alias("category_id"), F.col("p_brand").alias("category_name")).distinct()

    @property
    def film_category(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("film_id"), F.col("p_brand").alias("category_id"))

    @property
    def film_actor(self) -> DataFrame:
        return self.t.lineitem.select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id")).distinct()

    @property
    def inventory(self) -> DataFrame:
        items = self.t.lineitem.select("l_partkey", "l_suppkey").distinct()
        stores = self.t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id"))
        return items.join(stores, "l_suppkey").select(
            _dash("l_partkey", "l_suppkey").alias("inventory_id"), F.col("l_partkey").alias("film_id"), "store_id"
        )

    @property
    def rental(self) -> DataFrame:
        # dealt by order at once, so that the same shuffle serves the triples and their order
        lines = self.t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate").repartition("l_orderkey")
        triples = lines.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.max("l_shipdate").alias("shipped"))
        orders = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        return triples.join(orders, triples["l_orderkey"] == orders["o_orderkey"]).select(
            _dash("l_orderkey", "l_partkey", "l_suppkey").alias("rental_id"),
            _dash("l_partkey", "l_suppkey").alias("inventory_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.col("o_orderdate").alias("rental_date"),
            F.when(F.col("o_orderstatus") == "F", F.greatest("shipped", "o_orderdate")).alias("return_date"),
            F.col("o_orderdate").alias("last_updated_dt"),
        )

    @property
    def payment(self) -> DataFrame:
        lines = spread(self.t.lineitem).select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"
        )
        orders = self.t.orders.select("o_orderkey", "o_custkey")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
            F.concat_ws(
                "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd"),
                F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
            ).alias("payment_id"),
            _dash("l_orderkey", "l_partkey", "l_suppkey").alias("rental_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("staff_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_shipdate").alias("payment_date"),
        )


# DuckDB text of the same derivations; each oracle names the ones it needs.
SHOP_SQL = {
    "s_customer": """SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
        split_part(c_name, '#', 2) AS last_name, c_mktsegment AS segment, c_acctbal >= 0 AS active,
        c_nationkey AS address_id, c_nationkey AS store_id FROM customer""",
    "s_address": "SELECT n_nationkey AS address_id, n_name AS address, n_nationkey AS city_id FROM nation",
    "s_city": "SELECT n_nationkey AS city_id, n_name AS city, n_regionkey AS country_id FROM nation",
    "s_country": "SELECT r_regionkey AS country_id, r_name AS country FROM region",
    "s_staff": """SELECT s_suppkey AS staff_id, split_part(s_name, '#', 1) AS first_name,
        split_part(s_name, '#', 2) AS last_name, s_acctbal >= 0 AS active,
        s_nationkey AS address_id, s_nationkey AS store_id FROM supplier""",
    "s_store": """SELECT n_nationkey AS store_id, n_nationkey AS city_id, min(s_suppkey) AS manager_staff_id
        FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""",
    "s_film": """SELECT p_partkey AS film_id, p_name AS title, p_type AS rating, p_size AS length,
        p_size AS rental_duration, CAST(p_size * 0.1::DOUBLE AS DECIMAL(4,2)) AS rental_rate,
        CAST(floor(p_retailprice) / 100 AS DECIMAL(5,2)) AS replacement_cost,
        CAST(DATE '2000-01-01' + p_size AS TIMESTAMP) AS last_update FROM part""",
    "s_film_category": "SELECT p_partkey AS film_id, p_brand AS category_id FROM part",
    "s_film_actor": "SELECT DISTINCT l_partkey AS film_id, l_suppkey AS actor_id FROM lineitem",
    "s_inventory": """SELECT DISTINCT l_partkey || '-' || l_suppkey AS inventory_id, l_partkey AS film_id,
        s_nationkey AS store_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "s_rental": """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey AS rental_id,
        l_partkey || '-' || l_suppkey AS inventory_id, o_custkey AS customer_id, l_suppkey AS staff_id,
        o_orderdate AS rental_date,
        CASE WHEN o_orderstatus = 'F' THEN greatest(max(l_shipdate), o_orderdate) END AS return_date,
        o_orderdate AS last_updated_dt
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY l_orderkey, l_partkey, l_suppkey, o_custkey, o_orderdate, o_orderstatus""",
    "s_payment": """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' ||
        strftime(l_shipdate, '%Y%m%d') || '-' || CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_id,
        l_orderkey || '-' || l_partkey || '-' || l_suppkey AS rental_id, o_custkey AS customer_id,
        l_suppkey AS staff_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        CAST(l_discount AS DECIMAL(4,2)) AS discount, l_returnflag AS flag, l_shipdate AS payment_date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
}


def with_tables(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """A SQL text whose leading WITH defines the named tables."""
    known = {**SHOP_SQL, **(extra or {})}
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in names.split()) + "\n" + body


FIRST_LOAD = "2002-01-01 06:00:00"
SECOND_LOAD = "2002-02-01 18:00:00"


def load_time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


class Vault:
    """Hubs, links and two-version satellites over the shop tables.

    The second version exists only where an attribute changed: inactive customers moved to the
    segment CLOSED, and returned payments (flag R) were discounted.
    """

    def __init__(self, t: Tables, **dealt: tuple[str, ...]):
        """``dealt`` names tables whose rows are dealt by their own hash once for all readers, and the columns these need."""
        self.shop, self.dealt = Shop(t), dealt

    def source(self, table: str) -> DataFrame:
        rows = getattr(self.shop, table)
        return vault.dealt(rows.select(f"{table}_id", *self.dealt[table]), f"{table}_id") if table in self.dealt else rows

    def hub(self, table: str, key: str) -> DataFrame:
        own = business_hash([key]) if table in self.dealt else None
        return vault.hub_rows(self.source(table), [key], f"{table}_hk", load_time(FIRST_LOAD), table, own)

    def link(self, table: str, name: str, keep_text: bool = False, dealt_by: str | None = None, **references: str) -> DataFrame:
        """``dealt_by`` deals the link's rows by a hash that isn't the table's own."""
        rows, own = self.source(table), f"{table}_hk" if table in self.dealt else None
        if dealt_by is not None:
            rows, own = vault.dealt(getattr(self.shop, table).select(*references.values()), references[dealt_by]), dealt_by
        return vault.link_rows(rows, references, name, load_time(FIRST_LOAD), table, dealt_by=own, keep_text=keep_text)

    def satellite(self, table: str, key: str, tracked: list[str], rows: DataFrame | None = None, at: str = FIRST_LOAD) -> DataFrame:
        source = self.source(table) if rows is None else rows
        return vault.satellite_rows(source, key, f"{table}_hk", tracked, load_time(at), table)

    @property
    def sat_customer(self) -> DataFrame:
        tracked = ["first_name", "last_name", "segment", "active"]
        changed = self.shop.customer.filter("not active").withColumn("segment", F.lit("CLOSED"))
        return self.satellite("customer", "customer_id", tracked).unionByName(
            self.satellite("customer", "customer_id", tracked, changed, SECOND_LOAD)
        )

    @property
    def sat_payment_pricing(self) -> DataFrame:
        """Both versions of a payment come from one reading of it."""
        first = F.col("amount").cast("decimal(18,4)")
        second = (first * (1 - F.col("discount"))).cast("decimal(18,4)")
        version = lambda at, amount: F.struct(load_time(at).alias("at"), amount.alias("amount"))
        versions = F.array(version(FIRST_LOAD, first), F.when(F.col("flag") == "R", version(SECOND_LOAD, second)))
        rows = self.source("payment").select("payment_id", F.inline(F.array_compact(versions)))
        return vault.satellite_rows(rows, "payment_id", "payment_hk", ["amount"], F.col("at"), "payment")

    @property
    def sat_payment_core(self) -> DataFrame:
        return self.satellite("payment", "payment_id", ["payment_date"])

    @property
    def sat_rental(self) -> DataFrame:
        return self.satellite("rental", "rental_id", ["rental_date", "return_date"])

    @property
    def sat_film(self) -> DataFrame:
        return self.satellite("film", "film_id", ["title", "rating", "length"])

    @property
    def sat_film_pricing(self) -> DataFrame:
        return self.satellite("film", "film_id", ["rental_rate", "rental_duration", "replacement_cost"])

    @property
    def sat_staff(self) -> DataFrame:
        return self.satellite("staff", "staff_id", ["first_name", "last_name", "active"])

    @property
    def sat_category(self) -> DataFrame:
        rows = self.shop.category.withColumnRenamed("category_name", "name")
        return self.satellite("category", "category_id", ["name"], rows)


def hk(column: str) -> str:
    """DuckDB text of a one-column business hash."""
    return f"sha256(upper(trim(CAST({column} AS VARCHAR))))"


__all__ = ["SHOP_SQL", "Shop", "Vault", "business_hash", "hk", "load_time", "with_tables"]
