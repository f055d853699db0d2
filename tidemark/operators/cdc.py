"""Change-event decoding: envelope text to typed rows, driven by a field configuration."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.decimals import Encoded, with_decimals
from tidemark.sources.contracts import Field, TableConfig

META_COLUMNS = ("op", "event_time", "event_ts_ms", "bronze_offset", "bronze_partition", "kafka_timestamp")


def envelope_schema(fields: Sequence[Field]) -> T.StructType:
    """Envelope type holding exactly the leaves the configuration names, all as text."""
    leaves = sorted({path.split(".")[1] for f in fields for path in f.source_paths if path.count(".") == 1})
    record = T.StructType([T.StructField(leaf, T.StringType()) for leaf in leaves])
    payload = T.StructType(
        [
            T.StructField("before", record),
            T.StructField("after", record),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("payload", payload)])


def parse_envelopes(events: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Unwrap and parse each envelope once; only configured leaves are materialised."""
    parsed = F.from_json(F.col("value"), envelope_schema(fields))["payload"]
    return events.select(
        parsed.alias("_env"),
        F.col("offset").alias("bronze_offset"),
        F.col("partition").alias("bronze_partition"),
        "kafka_timestamp",
        F.col("value").alias("bronze_value"),
    ).select("_env.*", "bronze_offset", "bronze_partition", "kafka_timestamp", "bronze_value")


def first_present(paths: Sequence[str]) -> Column:
    """After image if present, else before image, in the order the paths are listed."""
    return F.coalesce(*[F.col(p) for p in paths])


def first_json(paths: Sequence[str], text: str = "bronze_value") -> Column:
    return F.coalesce(*[F.get_json_object(F.col(text), p) for p in paths])


def _row_scale(field: Field) -> Column | None:
    if not field.json_scale_paths:
        return None
    fallback = F.lit(field.scale if field.default_scale is None else field.default_scale)
    return F.coalesce(first_json(field.json_scale_paths).try_cast("int"), fallback)


# Transform names accepted in table configurations.
DIRECT: dict[str, Callable[[Field], Column]] = {
    "plain": lambda field: first_present(field.source_paths),
    "epoch_micros_to_timestamp": lambda field: F.timestamp_micros(first_present(field.source_paths).try_cast("bigint")),
}
ENCODED: dict[str, Callable[[Field], Column]] = {
    "decimal_from_debezium_bytes": lambda field: first_present(field.source_paths),
    "decimal_from_json_paths": lambda field: first_json(field.json_value_paths),
}


def _encoded(field: Field) -> Encoded:
    scale = _row_scale(field)
    if scale is None and field.transform == "decimal_from_json_paths" and field.default_scale is not None:
        scale = F.lit(field.default_scale)
    return Encoded(field.target, ENCODED[field.transform](field), field.precision, field.scale, scale)


def decode_events(events: DataFrame, config: TableConfig) -> DataFrame:
    """All configured columns plus operation and ordering metadata."""
    unknown = [f.transform for f in config.fields if f.transform not in DIRECT and f.transform not in ENCODED]
    if unknown:
        raise ValueError(f"unsupported transforms: {unknown}")
    parsed = parse_envelopes(events, config.fields)
    direct = [DIRECT[f.transform](f).alias(f.target) for f in config.fields if f.transform in DIRECT]
    rows = with_decimals(
        parsed.select(
            *direct,
            "before", "after", "bronze_value", "op",
            F.timestamp_millis(F.col("ts_ms")).alias("event_time"),
            F.col("ts_ms").alias("event_ts_ms"),
            "bronze_offset", "bronze_partition", "kafka_timestamp",
        ),
        [_encoded(f) for f in config.fields if f.transform in ENCODED],
    )
    return rows.select(*[f.target for f in config.fields], *META_COLUMNS)
