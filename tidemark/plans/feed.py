"""Change events derived from the orders and customer tables.

Every order is created with status O at its order date. Orders that ended as F or P get an
update 30 days later; urgent F orders also get a late, out-of-order update dated 10 days after
the order but carrying the highest offset; low-priority P orders are deleted after 60 days by an
event whose before image holds only the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.decimals import encode_integer
from tidemark.session import Tables, spread
from tidemark.sources.contracts import Field, TableConfig

DAY_MS = 86400000
TOPIC = "cdc.public.orders"

ORDERS = TableConfig(
    name="orders",
    primary_keys=("order_id",),
    fields=(
        Field("order_id", source_paths=("after.order_id", "before.order_id")),
        Field("customer_id", source_paths=("after.customer_id", "before.customer_id")),
        Field("status", source_paths=("after.status", "before.status")),
        Field("priority", source_paths=("after.priority", "before.priority")),
        Field(
            "ordered_at", "epoch_micros_to_timestamp", source_paths=("after.ordered_at", "before.ordered_at")
        ),
        Field(
            "total", "decimal_from_debezium_bytes", source_paths=("after.total", "before.total"), precision=12, scale=2
        ),
    ),
)

CUSTOMER = TableConfig(
    name="customer",
    primary_keys=("customer_id",),
    fields=(
        Field("customer_id", source_paths=("after.customer_id", "before.customer_id")),
        Field("name", source_paths=("after.name", "before.name")),
        Field(
            "balance", "decimal_from_json_paths", precision=18, scale=4, default_scale=2,
            json_value_paths=("$.payload.after.balance.value", "$.payload.before.balance.value"),
            json_scale_paths=("$.payload.after.balance.scale", "$.payload.before.balance.scale"),
        ),
    ),
)


def _millis(column: Column) -> Column:
    return F.unix_millis(column.cast("timestamp"))


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _value(before: Column, after: Column, op: str, ts_ms: Column, table: str) -> Column:
    payload = F.struct(
        before.alias("before"), after.alias("after"), F.lit(op).alias("op"), ts_ms.alias("ts_ms"),
        F.struct(F.lit(table).alias("table")).alias("source"),
    )
    return F.to_json(F.struct(payload.alias("payload")))


def order_landing(t: Tables, parts: int | None = None) -> DataFrame:
    """Landing records of the whole orders table, in one scan.

    ``parts`` deals the orders to as many tasks before the records, which are far longer, are made of them.
    """
    created = _millis(F.col("o_orderdate"))
    image_type = "struct<order_id:bigint,customer_id:bigint,status:string,priority:string,ordered_at:bigint,total:string>"

    def image(status: Column) -> Column:
        return F.struct(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("status"),
            F.col("o_orderpriority").alias("priority"), (created * 1000).alias("ordered_at"),
            encode_integer(_cents("o_totalprice")).alias("total"),
        ).cast(image_type)

    nothing = F.lit(None).cast(image_type)
    key_only = F.struct(F.col("o_orderkey").alias("order_id"))
    opened, final = image(F.lit("O")), image(F.col("o_orderstatus"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")

    def event(slot: int, days: int, op: str, before: Column, after: Column) -> Column:
        at = created + days * DAY_MS
        return F.struct(
            (F.col("o_orderkey") * 4 + slot).alias("offset"), at.alias("timestamp"), _value(before, after, op, at, "orders").alias("value")
        )

    events = F.array(
        event(0, 0, "c", nothing, opened),
        F.when(status != "O", event(1, 30, "u", opened, final)),
        F.when((status == "P") & (priority == "5-LOW"), event(2, 60, "d", key_only, nothing)),
        F.when((status == "F") & (priority == "1-URGENT"), event(3, 10, "u", opened, image(F.lit("P")))),
    )
    rows = spread(t.orders) if parts is None else t.orders.repartition(parts)
    return rows.select(
        F.col("o_orderkey").cast("string").alias("message_key"), F.explode(F.array_compact(events)).alias("e")
    ).select(
        F.lit(TOPIC).alias("topic"), F.pmod(F.xxhash64("message_key"), F.lit(8)).cast("int").alias("partition"),
        "e.offset", "e.timestamp", "message_key", "e.value",
    )


def drifting_landing(t: Tables) -> DataFrame:
    """The order feed with updates that repeat a key under another type, and cut creations of one priority."""
    text = F.col("value")
    cut = text.contains('"op":"c"') & text.contains('"priority":"4-NOT SPECIFIED"')
    repeated = F.replace(text, F.lit('"order_id":'), F.lit('"order_id":"x","order_id":'))
    return order_landing(t).withColumn(
        "value", F.when(cut, F.substring(text, 1, 10)).when(text.contains('"op":"u"'), repeated).otherwise(text)
    )


def order_events(t: Tables) -> DataFrame:
    """The same events in their stored (normalised) layout."""
    from tidemark.sources.landing import normalise_landing

    return normalise_landing(order_landing(t), F.lit("2002-01-01 00:00:00").cast("timestamp"))


def customer_landing(t: Tables) -> DataFrame:
    """Create events of all customers, balances as signed bytes; odd segments carry a scale."""
    scaled = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    balance = F.struct(
        F.when(scaled, F.lit(4)).alias("scale"),
        encode_integer(F.when(scaled, _cents("c_acctbal") * 100).otherwise(_cents("c_acctbal"))).alias("value"),
    )
    after = F.struct(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), balance.alias("balance"))
    at = F.lit(1009843200000).cast("bigint")
    return t.customer.select(
        F.lit("cdc.public.customer").alias("topic"), F.lit(0).alias("partition"), F.col("c_custkey").alias("offset"),
        at.alias("timestamp"), F.col("c_custkey").cast("string").alias("message_key"),
        _value(F.lit(None).cast("string"), after, "c", at, "customer").alias("value"),
    )


def faulty_landing(t: Tables) -> DataFrame:
    """The order feed with faults on some classes of orders, for validation and quarantine.

    By order status and priority: P/1 null, P/2 blank, P/3 truncated, P/4 trailing text,
    F/1 unknown operation, F/2 no source table, F/3 duplicate key text (still valid).
    """
    feed = order_landing(t).filter(F.get_json_object("value", "$.payload.op") == "c")
    origin = t.orders.select(
        F.col("o_orderkey").cast("string").alias("message_key"),
        F.concat(F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)).alias("class"),
    )
    text = F.col("value")
    broken = (
        F.when(F.col("class") == "P1", F.lit(None).cast("string"))
        .when(F.col("class") == "P2", F.lit("  \t\n "))
        .when(F.col("class") == "P3", F.substring(text, F.lit(1), F.length(text) - 2))
        .when(F.col("class") == "P4", F.concat(text, F.lit(" }x")))
        .when(F.col("class") == "F1", F.replace(text, F.lit('"op":"c"'), F.lit('"op":"x"')))
        .when(F.col("class") == "F2", F.replace(text, F.lit('"table":"orders"'), F.lit('"table":""')))
        .when(F.col("class") == "F3", F.replace(text, F.lit('"op":"c"'), F.lit('"op":"c","note":"a {brace} and \\" quote"')))
        .otherwise(text)
    )
    return feed.join(origin, "message_key").withColumn("value", broken).select(
        "topic", "partition", "offset", "timestamp", "message_key", "value"
    )
