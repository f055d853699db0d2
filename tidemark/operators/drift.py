"""Schema drift measured on the events themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.contracts import POLICIES

#: Type in a profile, and change, that stands for events that could not be read.
UNPARSED = "unparsed"


class SchemaDriftError(RuntimeError):
    """Raised when the policy does not allow the drift that was found."""


def field_profile(events: DataFrame, images: Column | Sequence[Column], by: str) -> DataFrame:
    """Fields and JSON types that occur in the events' objects, with event counts.

    ``images`` are the JSON texts of an event's objects, such as before and after. Each is parsed once into typed
    members, so the text "12" is told from the number 12; repeated keys keep all their types. An event counts
    once for a field and type, in however many images these occur. An event with an image that can't be parsed,
    or with none, also counts in a row of its table with no field and the type ``unparsed``.
    """
    images = [images] if isinstance(images, Column) else list(images)
    texts = F.array_compact(F.array(*images))
    parsed = events.select(by, F.transform(texts, lambda j: F.from_json(j, "map<string,variant>")).alias("_maps"))
    unread = (F.size("_maps") == 0) | F.exists("_maps", lambda m: m.isNull())
    # one reading of a member's type; an event's set of pairs is counted whole, as most events have the same few
    named = F.transform(
        F.flatten(F.transform(F.array_compact("_maps"), F.map_entries)), lambda e: F.struct(e["key"].alias("field"), F.schema_of_variant(e["value"]).alias("found"))
    )
    read = parsed.select(by, named.alias("_members"), unread.alias("_unread"))

    def kind(found: Column) -> Column:
        return (
            F.when(found == "VOID", "null")
            .when(found.startswith("OBJECT"), "object")
            .when(found.startswith("ARRAY"), "array")
            .when(found == "BOOLEAN", "boolean")
            .when(found == "STRING", "string")
            .otherwise("number")
        )

    def pair(field: Column, json_type: Column) -> Column:
        return F.struct(field.alias("field"), json_type.alias("json_type"))

    members = F.transform("_members", lambda e: pair(e["field"], kind(e["found"])))
    lost = F.when(F.col("_unread"), F.array(pair(F.lit(None).cast("string"), F.lit(UNPARSED)))).otherwise(F.array())
    shapes = read.groupBy(by, F.array_union(members, lost).alias("_shape")).agg(F.count(F.lit(1)).alias("_n"))
    pairs = shapes.select(by, F.explode("_shape").alias("_p"), "_n")
    return pairs.groupBy(by, F.col("_p.field").alias("field"), F.col("_p.json_type").alias("json_type")).agg(
        F.sum("_n").alias("n_events")
    )


def classify_drift(profile: DataFrame, contract: DataFrame, by: str) -> DataFrame:
    """Added, removed and type-changed fields per table, and a row without a field for tables with unparsed events.

    ``contract`` has one row per table and field with the allowed ``json_type``. Nulls never
    contradict a type.
    """
    lost = profile.filter(F.col("json_type") == UNPARSED).select(by, F.lit(UNPARSED).alias("change")).distinct()
    profile = profile.filter(F.col("json_type") != UNPARSED)
    seen = profile.filter("json_type <> 'null'").groupBy(by, "field").agg(
        F.array_join(F.array_sort(F.collect_set("json_type")), ",").alias("seen_type")
    )
    allnull = profile.select(by, "field").distinct()
    occurring = allnull.join(seen, [by, "field"], "left")
    wanted = contract.select(by, "field", F.col("json_type").alias("contract_type"))
    return (
        occurring.withColumn("_seen", F.lit(True))
        .join(wanted.withColumn("_wanted", F.lit(True)), [by, "field"], "full_outer")
        .withColumn(
            "change",
            F.when(F.col("_wanted").isNull(), "added")
            .when(F.col("_seen").isNull(), "removed")
            .when(F.col("seen_type").isNotNull() & (F.col("seen_type") != F.col("contract_type")), "type_changed"),
        )
        .filter("change is not null")
        .select(by, "field", "contract_type", "seen_type", "change")
        .unionByName(lost, allowMissingColumns=True)
    )


def drift_severity(changes: DataFrame, tables: DataFrame, by: str, policy: str = "strict", allow_additive: bool = False) -> DataFrame:
    """Severity and policy verdict per table: NONE, WARNING (additions, unparsed events) or CRITICAL.

    Only the strict policy blocks unparsed events. ``allow_additive`` gives the lenient reading of the strict policy, where additions pass.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown drift policy {policy!r}")
    listed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("change") == kind, F.col("field"))))
    summary = changes.groupBy(by).agg(
        listed("added").alias("added_columns"),
        listed("removed").alias("removed_columns"),
        listed("type_changed").alias("type_changes"),
        F.max(F.col("change") == UNPARSED).alias("has_unparsed"),
    )
    filled = tables.select(by).distinct().join(summary, by, "left")
    empty = F.array().cast("array<string>")
    names = ("added_columns", "removed_columns", "type_changes")
    filled = filled.withColumns(
        {c: F.coalesce(F.col(c), empty) for c in names} | {"has_unparsed": F.coalesce("has_unparsed", F.lit(False))}
    )
    breaking = (F.size("removed_columns") + F.size("type_changes")) > 0
    additive = F.size("added_columns") > 0
    unread = F.col("has_unparsed")
    if policy == "permissive":
        blocked = F.lit(False)
    elif policy == "additive_only":
        blocked = breaking
    else:
        blocked = breaking | unread if allow_additive else breaking | additive | unread
    return filled.withColumns(
        {
            "severity": F.when(breaking, "CRITICAL").when(additive | unread, "WARNING").otherwise("NONE"),
            "is_valid": ~blocked,
        }
    )


def require_no_drift(verdicts: DataFrame, by: str) -> None:
    """Gate: raise for the first blocked table. At most one row reaches the driver."""
    row = verdicts.filter(~F.col("is_valid")).orderBy(by).first()
    if row is not None:
        raise SchemaDriftError(
            f"{row[by]}: severity {row['severity']}, added {row['added_columns']}, "
            f"removed {row['removed_columns']}, changed {row['type_changes']}, unparsed {row['has_unparsed']}"
        )


def drift_log(verdicts: DataFrame, by: str, source_system: str, run_id: str, detected_at: Column) -> DataFrame:
    """Log rows of the tables that drifted."""
    return verdicts.filter("severity <> 'NONE'").select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(source_system).alias("source_system"),
        F.col(by).alias("table_name"),
        "severity", "added_columns", "removed_columns", "type_changes", "is_valid",
        detected_at.alias("detected_at"),
    )


def compare_contracts(expected: Mapping[str, str], actual: Mapping[str, str]) -> dict[str, list[str]]:
    """Names added, removed and type-changed between two schemas given as name -> type."""
    shared = expected.keys() & actual.keys()
    return {
        "added": sorted(actual.keys() - expected.keys()),
        "removed": sorted(expected.keys() - actual.keys()),
        "type_changed": sorted(n for n in shared if expected[n] != actual[n]),
    }
