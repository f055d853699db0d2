"""Queries: marts and source-database reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import marts, reports, upsert
from tidemark.plans.registry import query
from tidemark.plans.shop import Shop, Vault, hk, with_tables
from tidemark.session import Tables, stored

AS_OF = "2002-03-01"

# Latest amount of every payment: returned ones (flag R) carry their discount.
PAID = "CAST(CASE WHEN flag = 'R' THEN amount * (1 - discount) ELSE amount END AS DECIMAL(18,4))"


def avg_sql(total: str, n: str) -> str:
    """Half-up average to two places in whole-number arithmetic, for amounts with four places."""
    return f"CAST((2 * CAST({total} * 10000 AS HUGEINT) + 100 * {n}) // (200 * {n}) AS DOUBLE) / 100"


def as_of():
    return F.lit(AS_OF).cast("date")


FILM_SQL = with_tables("s_film", """
SELECT film_id, title, CAST(rental_rate AS DOUBLE) AS rental_rate, CAST(replacement_cost AS DOUBLE) AS replacement_cost,
  CAST(last_update AS VARCHAR) AS last_update,
  CASE WHEN rental_rate < 1 THEN 'budget' WHEN rental_rate < 3 THEN 'standard' ELSE 'premium' END AS rental_rate_tier FROM s_film""")
FILM_COLUMNS = ("film_id", "title", "rental_rate", "replacement_cost", "last_update", "rental_rate_tier")


@query("mart_film", FILM_SQL)
def mart_film(t: Tables) -> DataFrame:
    return marts.film_mart(Shop(t).film).select(*FILM_COLUMNS)


@query("mart_film_incremental", FILM_SQL)
def mart_film_incremental(t: Tables) -> DataFrame:
    """A stored mart that ends at a date, refreshed from its own high-water mark on."""
    film = Shop(t).film
    mark = F.date_add(F.lit("2000-01-01").cast("date"), 30).cast("timestamp_ntz")
    existing = marts.film_mart(film.filter(F.col("last_update") <= mark))
    outdated = existing.withColumn("title", F.when(F.col("last_update") == mark, "?").otherwise(F.col("title")))
    return upsert.refresh_since(outdated, marts.film_mart(film), ["film_id"], "last_update").select(*FILM_COLUMNS)


RENTAL_SQL = with_tables("s_rental s_payment s_customer", """
SELECT r.rental_id, r.customer_id, CAST(r.rental_date AS VARCHAR) AS rental_date, CAST(r.return_date AS VARCHAR) AS return_date,
  CASE WHEN r.return_date IS NULL THEN 'open' ELSE 'returned' END AS rental_status, CAST(p.total_paid AS DOUBLE) AS total_paid
FROM s_rental r LEFT JOIN (SELECT rental_id, sum(amount) AS total_paid FROM s_payment GROUP BY 1) p ON p.rental_id = r.rental_id
WHERE r.customer_id NOT IN (SELECT customer_id FROM s_customer WHERE NOT active)""")


def _rental_mart(t: Tables) -> DataFrame:
    """Inactive customers stand for erased subjects; a null registry entry must not matter."""
    s = Shop(t)
    erased = s.customer.select(F.when(~F.col("active"), F.col("customer_id").cast("string")).alias("subject_id"))
    return marts.rental_mart(s.rental, s.payment, erased)


RENTAL_COLUMNS = ("rental_id", "customer_id", "rental_date", "return_date", "rental_status", "total_paid")


@query("mart_rental", RENTAL_SQL)
def mart_rental(t: Tables) -> DataFrame:
    return _rental_mart(t).select(*RENTAL_COLUMNS)


@query("mart_rental_incremental", RENTAL_SQL)
def mart_rental_incremental(t: Tables) -> DataFrame:
    """A stored mart without the last years, refreshed from its high-water mark on; the mart's rows are made and written once."""
    source = stored(_rental_mart(t).select(*RENTAL_COLUMNS, "last_updated_dt"), "rental-mart")
    table = source.filter(F.col("last_updated_dt") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return upsert.refresh_since(table, source, ["rental_id"], "last_updated_dt").select(*RENTAL_COLUMNS)


def _customer_sql(paid: str, factor: str) -> str:
    return with_tables("s_customer s_rental s_payment", f""",
r AS (SELECT customer_id, count(*) AS n, min(rental_date) AS f, max(rental_date) AS l FROM s_rental GROUP BY 1),
p AS (SELECT customer_id, CAST({factor} AS BIGINT) AS n, sum({paid}) AS total FROM s_payment GROUP BY 1)
SELECT {hk('c.customer_id')} AS customer_hk, c.customer_id, c.last_name, CASE WHEN c.active THEN c.segment ELSE 'CLOSED' END AS segment,
  coalesce(r.n, 0) AS total_rentals, coalesce(p.n, 0) AS total_payments, CAST(coalesce(p.total, 0) AS DOUBLE) AS total_spend,
  coalesce({avg_sql('p.total', 'p.n')}, 0) AS avg_payment,
  CAST(r.f AS VARCHAR) AS first_rental_date, CAST(r.l AS VARCHAR) AS last_rental_date,
  CAST(coalesce(date_diff('day', r.f, r.l), 0) AS INTEGER) AS active_days,
  CASE WHEN coalesce(p.total, 0) >= 100 THEN 'Gold' WHEN coalesce(p.total, 0) >= 40 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
FROM s_customer c LEFT JOIN r ON r.customer_id = c.customer_id LEFT JOIN p ON p.customer_id = c.customer_id""")


CUSTOMER_COLUMNS = (
    "customer_hk", "customer_id", "last_name", "segment", "total_rentals", "total_payments", "total_spend", "avg_payment",
    "first_rental_date", "last_rental_date", "active_days", "customer_tier",
)


def _customer_summary(t: Tables, all_versions: bool) -> DataFrame:
    v = Vault(t, rental=("customer_id", "rental_date", "return_date"), payment=("customer_id", "amount", "discount", "flag"))
    return marts.customer_summary(
        v.hub("customer", "customer_id"), v.sat_customer,
        v.link("rental", "rental_customer_hk", rental_hk="rental_id", customer_hk="customer_id"), v.sat_rental,
        v.link("payment", "payment_customer_hk", payment_hk="payment_id", customer_hk="customer_id"), v.sat_payment_pricing,
        as_of(), all_versions, dealt=("rental_hk", "payment_hk"),
    ).select(*CUSTOMER_COLUMNS)


@query("mart_customer_summary", _customer_sql(PAID, "count(*)"))
def mart_customer_summary(t: Tables) -> DataFrame:
    return _customer_summary(t, False)


@query("mart_customer_summary_all_versions", _customer_sql(
    "amount + CASE WHEN flag = 'R' THEN CAST(amount * (1 - discount) AS DECIMAL(18,4)) ELSE 0 END", "count(*) + count_if(flag = 'R')"))
def mart_customer_summary_all_versions(t: Tables) -> DataFrame:
    return _customer_summary(t, True)


@query("mart_film_popularity", with_tables("s_film s_rental s_inventory s_payment s_film_category", f""",
r AS (SELECT i.film_id, count(*) AS n FROM s_rental r JOIN s_inventory i ON i.inventory_id = r.inventory_id GROUP BY 1),
p AS (SELECT i.film_id, sum({PAID}) AS total FROM s_payment p JOIN s_rental r ON r.rental_id = p.rental_id
  JOIN s_inventory i ON i.inventory_id = r.inventory_id GROUP BY 1)
SELECT {hk('f.film_id')} AS film_hk, f.film_id, f.title, f.rating, CAST(f.rental_rate AS DOUBLE) AS rental_rate, c.category_id AS category_name,
  coalesce(r.n, 0) AS total_rentals, CAST(round(coalesce(p.total, 0), 2) AS DOUBLE) AS total_revenue,
  CAST(dense_rank() OVER (ORDER BY coalesce(r.n, 0) DESC) AS INTEGER) AS popularity_rank
FROM s_film f LEFT JOIN r ON r.film_id = f.film_id LEFT JOIN p ON p.film_id = f.film_id LEFT JOIN s_film_category c ON c.film_id = f.film_id"""))
def mart_film_popularity(t: Tables) -> DataFrame:
    v = Vault(t, payment=("rental_id", "amount", "discount", "flag"), inventory=("film_id",))
    return marts.film_popularity(
        v.hub("film", "film_id"), v.sat_film, v.sat_film_pricing,
        v.link("inventory", "inventory_film_hk", keep_text=True, inventory_hk="inventory_id", film_hk="film_id"),
        v.link("rental", "rental_inventory_hk", keep_text=True, dealt_by="inventory_hk", rental_hk="rental_id", inventory_hk="inventory_id"),
        v.link("payment", "payment_rental_hk", payment_hk="payment_id", rental_hk="rental_id"), v.sat_payment_pricing,
        v.link("film_category", "film_category_hk", film_hk="film_id", category_hk="category_id"), v.sat_category,
        dealt=("payment_hk", "inventory_hk"),
    ).select("film_hk", "film_id", "title", "rating", "rental_rate", "category_name", "total_rentals", "total_revenue", "popularity_rank")


@query("mart_inventory_status", with_tables("s_inventory s_rental s_film", f""",
last AS (SELECT *, row_number() OVER (PARTITION BY inventory_id ORDER BY rental_date DESC, {hk('rental_id')} DESC) AS rn FROM s_rental),
st AS (SELECT i.film_id, l.rental_date IS NOT NULL AND l.return_date IS NULL AS rented,
  date_diff('day', l.rental_date, TIMESTAMP '{AS_OF}') > 14 AS old FROM s_inventory i LEFT JOIN last l ON l.inventory_id = i.inventory_id AND l.rn = 1)
SELECT {hk('s.film_id')} AS film_hk, f.title, count(*) AS total_copies, CAST(count_if(rented) AS BIGINT) AS copies_rented,
  CAST(count_if(NOT rented) AS BIGINT) AS copies_available, CAST(count_if(rented AND old) AS BIGINT) AS overdue_copies
FROM st s LEFT JOIN s_film f ON f.film_id = s.film_id GROUP BY s.film_id, f.title"""))
def mart_inventory_status(t: Tables) -> DataFrame:
    v = Vault(t, rental=("inventory_id", "rental_date", "return_date"), inventory=("film_id",))
    return marts.inventory_status(
        v.hub("inventory", "inventory_id"),
        v.link("inventory", "inventory_film_hk", inventory_hk="inventory_id", film_hk="film_id"), v.sat_film,
        v.link("rental", "rental_inventory_hk", rental_hk="rental_id", inventory_hk="inventory_id"), v.sat_rental, as_of(),
        dealt=("rental_hk", "inventory_hk"),
    )


@query("mart_inventory_status_any_return", with_tables("s_inventory s_rental s_film", f"""
, last AS (SELECT inventory_id, max(rental_date) AS rental_date, max(return_date) AS return_date FROM s_rental GROUP BY 1)
SELECT {hk('i.film_id')} AS film_hk, f.title, count(*) AS total_copies,
  CAST(count_if(l.rental_date IS NOT NULL AND l.return_date IS NULL) AS BIGINT) AS copies_rented,
  CAST(count_if(l.rental_date IS NULL OR l.return_date IS NOT NULL) AS BIGINT) AS copies_available
FROM s_inventory i LEFT JOIN last l ON l.inventory_id = i.inventory_id LEFT JOIN s_film f ON f.film_id = i.film_id GROUP BY i.film_id, f.title"""))
def mart_inventory_status_any_return(t: Tables) -> DataFrame:
    """The lenient reading: one return makes a copy available for good."""
    v = Vault(t, rental=("inventory_id", "rental_date", "return_date"), inventory=("film_id",))
    return marts.inventory_status(
        v.hub("inventory", "inventory_id"),
        v.link("inventory", "inventory_film_hk", inventory_hk="inventory_id", film_hk="film_id"), v.sat_film,
        v.link("rental", "rental_inventory_hk", rental_hk="rental_id", inventory_hk="inventory_id"), v.sat_rental, as_of(),
        latest_rental_only=False, dealt=("rental_hk", "inventory_hk"),
    ).drop("overdue_copies")


@query("mart_revenue_by_store", with_tables("s_payment s_staff", f"""
SELECT CAST(CAST(p.payment_date AS DATE) AS VARCHAR) AS payment_day, {hk('s.store_id')} AS store_hk, count(*) AS total_transactions,
  CAST(sum({PAID}) AS DOUBLE) AS total_revenue, {avg_sql(f'sum({PAID})', 'count(*)')} AS avg_transaction,
  count(DISTINCT p.staff_id) AS active_staff_count
FROM s_payment p JOIN s_staff s ON s.staff_id = p.staff_id GROUP BY 1, s.store_id"""))
def mart_revenue_by_store(t: Tables) -> DataFrame:
    v = Vault(t, rental=("staff_id",), payment=("rental_id", "amount", "discount", "flag", "payment_date"))
    return marts.revenue_by_store(
        v.sat_payment_core, v.sat_payment_pricing,
        v.link("payment", "payment_rental_hk", keep_text=True, payment_hk="payment_id", rental_hk="rental_id"),
        v.link("rental", "rental_staff_hk", keep_text=True, rental_hk="rental_id", staff_hk="staff_id"),
        v.link("staff", "staff_store_hk", staff_hk="staff_id", store_hk="store_id"),
        dealt=("payment_hk", "rental_hk"),
    )


@query("mart_staff_performance", with_tables("s_payment s_staff s_rental", f""",
r AS (SELECT staff_id, count(*) AS n, min(rental_date) AS f, max(rental_date) AS l FROM s_rental GROUP BY 1),
p AS (SELECT staff_id, count(*) AS n, sum({PAID}) AS total FROM s_payment GROUP BY 1)
SELECT {hk('s.staff_id')} AS staff_hk, s.staff_id, s.last_name, s.active, {hk('s.store_id')} AS store_hk,
  coalesce(r.n, 0) AS total_rentals_handled, coalesce(p.n, 0) AS total_payments_processed,
  CAST(round(coalesce(p.total, 0), 2) AS DOUBLE) AS total_revenue_driven, coalesce({avg_sql('p.total', 'p.n')}, 0) AS avg_payment_amount,
  CAST(r.f AS VARCHAR) AS first_rental, CAST(r.l AS VARCHAR) AS last_rental,
  CAST(dense_rank() OVER (ORDER BY coalesce(p.total, 0) DESC) AS INTEGER) AS revenue_rank
FROM s_staff s LEFT JOIN r ON r.staff_id = s.staff_id LEFT JOIN p ON p.staff_id = s.staff_id"""))
def mart_staff_performance(t: Tables) -> DataFrame:
    v = Vault(t, rental=("staff_id", "rental_date", "return_date"), payment=("staff_id", "amount", "discount", "flag"))
    return marts.staff_performance(
        v.hub("staff", "staff_id"), v.sat_staff,
        v.link("staff", "staff_store_hk", staff_hk="staff_id", store_hk="store_id"),
        v.link("rental", "rental_staff_hk", rental_hk="rental_id", staff_hk="staff_id"), v.sat_rental,
        v.link("payment", "payment_staff_hk", payment_hk="payment_id", staff_hk="staff_id"), v.sat_payment_pricing,
        dealt=("rental_hk", "payment_hk"),
    ).select(
        "staff_hk", "staff_id", "last_name", "active", "store_hk", "total_rentals_handled", "total_payments_processed",
        "total_revenue_driven", "avg_payment_amount", "first_rental", "last_rental", "revenue_rank",
    )


@query("mart_orders", """
SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id, l_partkey AS product_id,
  coalesce(p_name, 'legacy ' || l_partkey) AS product_name, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
  CASE WHEN l_extendedprice < 20 THEN 'low' WHEN l_extendedprice < 60 THEN 'medium' ELSE 'high' END AS price_band,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS order_date,
  CAST(greatest(l_shipdate, coalesce(TIMESTAMP '1998-01-01', l_shipdate)) AS VARCHAR) AS last_updated_dt
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size >= 10) ON p_partkey = l_partkey WHERE p_partkey IS NOT NULL
UNION ALL SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber, l_partkey, 'legacy ' || l_partkey,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE), CASE WHEN l_extendedprice < 20 THEN 'low' WHEN l_extendedprice < 60 THEN 'medium' ELSE 'high' END,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR), CAST(l_shipdate AS VARCHAR)
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size >= 10)""")
def mart_orders(t: Tables) -> DataFrame:
    """Order lines against a product table that lacks the small sizes."""
    orders = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
        F.col("l_partkey").alias("product_id"), F.concat(F.lit("legacy "), "l_partkey").alias("product_legacy"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("last_inserted_dt"), F.col("l_shipdate").alias("last_updated_dt"),
    )
    products = t.part.filter("p_size >= 10").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("product_name"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    return marts.orders_mart(orders, products).drop("created_at", "last_inserted_dt")


@query("mart_products", """
SELECT p_partkey AS id, p_name AS product_name, p_size / 20.0::DOUBLE AS weight,
  CASE WHEN p_size < 10 THEN 'light' WHEN p_size < 30 THEN 'medium' ELSE 'heavy' END AS weight_class FROM part""")
def mart_products(t: Tables) -> DataFrame:
    products = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("product_name"), (F.col("p_size") / 20.0).alias("weight")
    )
    return marts.products_mart(products)


@query("mart_daily_revenue", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, r_name AS region, p_type AS product_category,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS total_revenue, count(*) AS order_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3""")
def mart_daily_revenue(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    places = t.customer.select("c_custkey", "c_nationkey").join(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    wide = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_category")), "l_partkey")
        .join(places, "o_custkey")
        .select(
            F.col("o_orderdate").cast("date").alias("order_date"), "region", "product_category", "o_orderstatus",
            F.col("l_orderkey").alias("order_id"),
            (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("revenue"),
        )
    )
    return marts.daily_revenue(wide, F.col("o_orderstatus") == "F")


@query("report_actor_info", with_tables("s_film_actor s_film_category s_film s_staff", """,
lines AS (SELECT actor_id, category_id || ': ' || string_agg(title, ', ' ORDER BY title) AS line
  FROM s_film_actor a JOIN s_film_category c ON c.film_id = a.film_id JOIN s_film f ON f.film_id = a.film_id GROUP BY actor_id, category_id)
SELECT staff_id AS actor_id, first_name, last_name, string_agg(line, ', ' ORDER BY line) AS film_info
FROM s_staff LEFT JOIN lines ON actor_id = staff_id GROUP BY 1, 2, 3"""))
def report_actor_info(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.actor_info(s.actor, s.film_actor, s.film_category, s.category, s.film)


@query("report_customer_list", with_tables("s_customer s_address s_city s_country", """
SELECT customer_id AS id, first_name || ' ' || last_name AS name, address, city, country,
  CASE WHEN active THEN 'active' ELSE '' END AS notes, store_id AS sid
FROM s_customer JOIN s_address USING (address_id) JOIN s_city USING (city_id) JOIN s_country USING (country_id)"""))
def report_customer_list(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.customer_list(s.customer, s.address, s.city, s.country)


def _film_list_sql(name: str) -> str:
    return with_tables("s_film s_film_category s_film_actor s_staff", f"""
SELECT f.film_id AS fid, f.title, c.category_id AS category, CAST(f.rental_rate AS DOUBLE) AS price, f.length, f.rating,
  string_agg({name}, ', ' ORDER BY {name}) AS actors
FROM s_film f JOIN s_film_category c ON c.film_id = f.film_id JOIN s_film_actor a ON a.film_id = f.film_id JOIN s_staff s ON s.staff_id = a.actor_id
GROUP BY 1, 2, 3, f.rental_rate, 5, 6""")


@query("report_film_list", _film_list_sql("s.first_name || ' ' || s.last_name"))
def report_film_list(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.film_list(s.film, s.film_category, s.category, s.film_actor, s.actor)


@query("report_nicer_film_list", _film_list_sql(
    "upper(substr(s.first_name, 1, 1)) || lower(substr(s.first_name, 2)) || upper(substr(s.last_name, 1, 1)) || lower(substr(s.last_name, 2))"))
def report_nicer_film_list(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.film_list(s.film, s.film_category, s.category, s.film_actor, s.actor, nicer=True)


@query("report_sales_by_category", with_tables("s_payment s_rental s_inventory s_film_category", """
SELECT c.category_id AS category, CAST(sum(p.amount) AS DOUBLE) AS total_sales FROM s_payment p JOIN s_rental r ON r.rental_id = p.rental_id
JOIN s_inventory i ON i.inventory_id = r.inventory_id JOIN s_film_category c ON c.film_id = i.film_id GROUP BY 1 ORDER BY 2 DESC"""))
def report_sales_by_category(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.sales_by_category(s.payment, s.rental, s.inventory, s.film_category, s.category)


@query("report_sales_by_store", with_tables("s_payment s_rental s_inventory s_store s_city s_country s_staff", """
SELECT st.store_id, ci.city || ',' || co.country AS store, m.first_name || ' ' || m.last_name AS manager, CAST(sum(p.amount) AS DOUBLE) AS total_sales
FROM s_payment p JOIN s_rental r ON r.rental_id = p.rental_id JOIN s_inventory i ON i.inventory_id = r.inventory_id
JOIN s_store st ON st.store_id = i.store_id JOIN s_city ci ON ci.city_id = st.city_id JOIN s_country co ON co.country_id = ci.country_id
JOIN s_staff m ON m.staff_id = st.manager_staff_id GROUP BY 1, 2, 3"""))
def report_sales_by_store(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.sales_by_store(s.payment, s.rental, s.inventory, s.store, s.city, s.country, s.staff)


@query("report_staff_list", with_tables("s_staff s_address s_city s_country", """
SELECT staff_id AS id, first_name || ' ' || last_name AS name, address, city, country, store_id AS sid
FROM s_staff JOIN s_address USING (address_id) JOIN s_city USING (city_id) JOIN s_country USING (country_id)"""))
def report_staff_list(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.staff_list(s.staff, s.address, s.city, s.country)


@query("report_film_in_stock", with_tables("s_inventory s_rental", """
SELECT film_id, store_id, inventory_id FROM s_inventory WHERE inventory_id NOT IN (SELECT inventory_id FROM s_rental WHERE return_date IS NULL)"""))
def report_film_in_stock(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.stock(s.inventory, s.rental)


@query("report_film_not_in_stock", with_tables("s_inventory s_rental", """
SELECT film_id, store_id, inventory_id FROM s_inventory WHERE inventory_id IN (SELECT inventory_id FROM s_rental WHERE return_date IS NULL)"""))
def report_film_not_in_stock(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.stock(s.inventory, s.rental, in_stock=False)


@query("report_customer_balance", with_tables("s_customer s_rental s_inventory s_film s_payment", """,
f AS (SELECT r.customer_id, sum(f.rental_rate) AS fees, sum(greatest(coalesce(date_diff('day', r.rental_date, r.return_date) - f.rental_duration, 0), 0)) AS late
  FROM s_rental r JOIN s_inventory i ON i.inventory_id = r.inventory_id JOIN s_film f ON f.film_id = i.film_id
  WHERE r.rental_date <= TIMESTAMP '1999-06-30' GROUP BY 1),
p AS (SELECT customer_id, sum(amount) AS paid FROM s_payment WHERE payment_date <= TIMESTAMP '1999-06-30' GROUP BY 1)
SELECT c.customer_id, CAST(coalesce(f.fees, 0) + coalesce(f.late, 0) - coalesce(p.paid, 0) AS DOUBLE) AS balance
FROM s_customer c LEFT JOIN f ON f.customer_id = c.customer_id LEFT JOIN p ON p.customer_id = c.customer_id"""))
def report_customer_balance(t: Tables) -> DataFrame:
    s = Shop(t)
    at = F.lit("1999-06-30").cast("timestamp_ntz")
    return reports.customer_balance(s.customer, s.rental, s.inventory, s.film, s.payment, at)


@query("report_inventory_holder", with_tables("s_rental", """
SELECT inventory_id, customer_id FROM (SELECT *, row_number() OVER (PARTITION BY inventory_id ORDER BY rental_date DESC, rental_id DESC) AS rn
FROM s_rental WHERE return_date IS NULL) WHERE rn = 1"""))
def report_inventory_holder(t: Tables) -> DataFrame:
    return reports.current_holder(Shop(t).rental)


@query("report_rewards", with_tables("s_customer s_payment", """
SELECT customer_id, first_name, last_name, segment FROM s_customer WHERE customer_id IN (
  SELECT customer_id FROM s_payment WHERE CAST(payment_date AS DATE) BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'
  GROUP BY customer_id HAVING sum(amount) > 50000 AND count(*) > 1)"""))
def report_rewards(t: Tables) -> DataFrame:
    s = Shop(t)
    return reports.rewards_report(
        s.customer, s.payment, F.lit("1998-05-01").cast("date"), 1, Decimal("50000")
    ).select("customer_id", "first_name", "last_name", "segment")


@query("report_group_concat", """
SELECT l_orderkey, string_agg(p_name, ', ' ORDER BY p_name) AS names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def report_group_concat(t: Tables) -> DataFrame:
    """Product names of every order in one text."""
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return reports.grouped_text(t.lineitem.select("l_orderkey", "l_partkey").join(names, "l_partkey"), ["l_orderkey"], F.col("p_name"), "names")
