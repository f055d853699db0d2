"""Set-wide forms of the source database's views and functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import ranged
from tidemark.operators.upsert import keep_first
from tidemark.session import stored

# Fixed value: separator of the concatenating aggregate.
SEPARATOR = ", "


def grouped_text(df: DataFrame, keys: Sequence[str], text: Column, name: str, separator: str = SEPARATOR, distinct: bool = False) -> DataFrame:
    """Each key's texts in order, joined; null texts count for nothing, and a key with none but these gets an empty text.

    Equal texts are counted map-side, and a key's texts are put in order by ranges of (key, text), so a key that holds
    much of the table is sorted by many tasks; only the finished pieces, one a range, meet for the key. The counted texts are
    written once, as the ranges' limits and the pieces both read them.
    """
    rows = df.select(*keys, text.cast("string").alias("_text")).groupBy(*keys, "_text").agg(F.count(F.lit(1)).alias("_copies"))
    rows = stored(rows, "grouped-text")
    found = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_text", "_copies"))))
    repeated = F.transform(found, lambda x: x["_text"]) if distinct else F.flatten(
        F.transform(found, lambda x: F.array_repeat(x["_text"], x["_copies"].cast("int"))))
    pieces = ranged(rows, keys, ["_text"]).groupBy(*keys, "_range").agg(repeated.alias("_texts"))
    piece = F.when(F.size("_texts") > 0, F.struct("_range", F.array_join("_texts", separator).alias("_piece")))
    ordered = F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["_piece"])
    return pieces.groupBy(*keys).agg(F.array_join(ordered, separator).alias(name))


def actor_info(actor: DataFrame, film_actor: DataFrame, film_category: DataFrame, category: DataFrame, film: DataFrame) -> DataFrame:
    """Per actor, one text of ``category: titles`` entries; actors without films stay, with null."""
    titles = (
        film_actor.join(film_category, "film_id")
        .join(category, "category_id")
        .join(film.select("film_id", "title"), "film_id")
    )
    lines = grouped_text(titles, ["actor_id", "category_id", "category_name"], F.col("title"), "titles")
    info = grouped_text(lines, ["actor_id"], F.concat("category_name", F.lit(": "), "titles"), "film_info", distinct=True)
    return actor.join(info, "actor_id", "left")


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Customers with place names and an active note."""
    return customer.join(address, "address_id").join(city, "city_id").join(country, "country_id").select(
        F.col("customer_id").alias("id"),
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        "address", "city", "country",
        F.when(F.col("active"), "active").otherwise("").alias("notes"),
        F.col("store_id").alias("sid"),
    )


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return staff.join(address, "address_id").join(city, "city_id").join(country, "country_id").select(
        F.col("staff_id").alias("id"),
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        "address", "city", "country", F.col("store_id").alias("sid"),
    )


def capitalised(first: Column, last: Column) -> Column:
    """Both names with a capital first letter, run together."""
    cap = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    return F.concat(cap(first), cap(last))


def film_list(film: DataFrame, film_category: DataFrame, category: DataFrame, film_actor: DataFrame, actor: DataFrame, nicer: bool = False) -> DataFrame:
    """Films per category with the list of their actors.

    The actor text is built once per film, then attached to each of the film's categories.
    """
    first, last = F.col("first_name"), F.col("last_name")
    name = capitalised(first, last) if nicer else F.concat(first, F.lit(" "), last)
    cast = grouped_text(film_actor.join(actor, "actor_id"), ["film_id"], name, "actors")
    return (
        film.join(cast, "film_id")
        .join(film_category, "film_id")
        .join(category, "category_id")
        .select(
            F.col("film_id").alias("fid"), "title", F.col("category_name").alias("category"),
            F.col("rental_rate").alias("price"), "length", "rating", "actors",
        )
    )


def sales_by_category(payment: DataFrame, rental: DataFrame, inventory: DataFrame, film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Total sales per category, highest first; payments are summed per film before the last joins."""
    per_film = (
        payment.groupBy("rental_id").agg(F.sum("amount").alias("paid"))
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id").agg(F.sum("paid").alias("paid"))
    )
    return (
        per_film.join(film_category, "film_id").join(category, "category_id")
        .groupBy(F.col("category_name").alias("category")).agg(F.sum("paid").alias("total_sales"))
        .orderBy(F.col("total_sales").desc(), "category")
    )


def sales_by_store(payment: DataFrame, rental: DataFrame, inventory: DataFrame, store: DataFrame, city: DataFrame, country: DataFrame, staff: DataFrame) -> DataFrame:
    """Total sales per store with its place and manager, ordered by place."""
    per_store = (
        payment.groupBy("rental_id").agg(F.sum("amount").alias("paid"))
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory.select("inventory_id", "store_id"), "inventory_id")
        .groupBy("store_id").agg(F.sum("paid").alias("total_sales"))
    )
    return (
        per_store.join(store, "store_id").join(city, "city_id").join(country, "country_id")
        .join(staff.select(F.col("staff_id").alias("manager_staff_id"), "first_name", "last_name"), "manager_staff_id")
        .select(
            "store_id",
            F.concat("city", F.lit(","), "country").alias("store"),
            F.concat_ws(" ", "first_name", "last_name").alias("manager"),
            "total_sales", "country", "city",
        )
        .orderBy("country", "city", "store_id")
        .drop("country", "city")
    )


def stock(inventory: DataFrame, rental: DataFrame, in_stock: bool = True) -> DataFrame:
    """Items of every (film, store) that are in stock, or out: an item is out while any rental is open."""
    out = rental.filter("return_date is null").select("inventory_id").distinct()
    kept = inventory.join(out, "inventory_id", "left_anti" if in_stock else "left_semi")
    return kept.select("film_id", "store_id", "inventory_id")


def current_holder(rental: DataFrame) -> DataFrame:
    """Customer holding each item that is out: the latest open rental decides."""
    open_rentals = rental.filter("return_date is null")
    return keep_first(
        open_rentals, ["inventory_id"], [F.col("rental_date").desc(), F.col("rental_id").desc()]
    ).select("inventory_id", "customer_id")


def customer_balance(customer: DataFrame, rental: DataFrame, inventory: DataFrame, film: DataFrame, payment: DataFrame, as_of: Column) -> DataFrame:
    """Balance of every customer at a date: rental fees + a unit per late day - payments."""
    before = rental.filter(F.col("rental_date") <= as_of)
    days_late = F.datediff("return_date", "rental_date") - F.col("rental_duration")
    fees = (
        before.join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(film.select("film_id", "rental_rate", "rental_duration"), "film_id")
        .groupBy("customer_id")
        .agg(
            F.sum("rental_rate").alias("fees"),
            F.sum(F.greatest(F.coalesce(days_late, F.lit(0)), F.lit(0))).alias("late_fees"),
        )
    )
    paid = payment.filter(F.col("payment_date") <= as_of).groupBy("customer_id").agg(F.sum("amount").alias("paid"))
    zero = F.lit(0)
    return (
        customer.select("customer_id").join(fees, "customer_id", "left").join(paid, "customer_id", "left")
        .select(
            "customer_id",
            (F.coalesce("fees", zero) + F.coalesce("late_fees", zero) - F.coalesce("paid", zero)).alias("balance"),
        )
    )


def rewards_report(customer: DataFrame, payment: DataFrame, month_start: Column, min_purchases: int, min_amount) -> DataFrame:
    """Customers above both thresholds in the month starting at ``month_start``."""
    if min_purchases <= 0 or min_amount <= 0:
        raise ValueError("both thresholds must be positive")
    day = F.col("payment_date").cast("date")
    good = (
        payment.filter((day >= month_start) & (day <= F.last_day(month_start)))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
        .filter((F.col("n") > min_purchases) & (F.col("total") > F.lit(min_amount)))
    )
    return customer.join(good, "customer_id", "left_semi")
