"""Named table contracts, drift policies and the table configuration they go with."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import types as T

def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_S, _L, _I, _D, _AT = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

# The landing record, event table and log layouts other jobs read.
LANDING = _fields(topic=_S, partition=_I, offset=_L, timestamp=_L, message_key=_S, value=_S)
BRONZE = _fields(
    topic=_S, partition=_I, offset=_L, kafka_timestamp=_AT, message_key=_S, value=_S, ingested_at=_AT,
    source_schema=_S, table_name=_S,
)
QUARANTINE = T.StructType([*BRONZE.fields, *_fields(quarantine_reason=_S, quarantined_at=_AT).fields])
DQ_RESULT = _fields(
    run_id=_S, layer=_S, table_name=_S, check_name=_S, status=_S, observed_value=_D, threshold=_D, message=_S, checked_at=_AT
)

CONTRACTS: dict[str, T.StructType] = {
    "bronze.event": BRONZE,
    "bronze.quarantine": QUARANTINE,
    "monitoring.dq_results": DQ_RESULT,
}
POLICIES = ("strict", "additive_only", "permissive")
LAYER_POLICY = {"bronze": "additive_only", "silver": "strict", "gold": "strict"}


def contract(key: str) -> T.StructType:
    """Contract by key; unknown keys are an error, never an empty schema."""
    try:
        return CONTRACTS[key]
    except KeyError:
        raise KeyError(f"no schema contract named {key!r}") from None


def register_contract(key: str, schema: T.StructType) -> None:
    CONTRACTS[key] = schema


@dataclass(frozen=True)
class Field:
    """One target column of a decoded change event."""

    target: str
    transform: str = "plain"
    source_paths: tuple[str, ...] = ()
    json_value_paths: tuple[str, ...] = ()
    json_scale_paths: tuple[str, ...] = ()
    precision: int = 38
    scale: int = 0
    default_scale: int | None = None


@dataclass(frozen=True)
class TableConfig:
    """How one source table's change events become its current-state table."""

    name: str
    primary_keys: tuple[str, ...]
    fields: tuple[Field, ...]
    dedupe_order_columns: tuple[str, ...] = ("event_ts_ms", "bronze_offset")
    merge_columns: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, name: str, config: dict) -> TableConfig:
        """From the stored configuration layout of one table."""
        known = {f.name for f in fields(Field)}
        mappings = [
            Field(**{k: tuple(v) if isinstance(v, list) else v for k, v in m.items() if k in known})
            for m in config["field_mappings"]
        ]
        return cls(
            name=name,
            primary_keys=tuple(config["primary_keys"]),
            fields=tuple(mappings),
            dedupe_order_columns=tuple(config.get("dedupe_order_columns", ("event_ts_ms", "bronze_offset"))),
            merge_columns=tuple(config.get("merge_core_fields", ())),
            foreign_keys=dict(config.get("fk_references", {})),
        )
