"""Hubs, links, satellites, integrity checks and the data-driven key classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.hashing import (
    KEY_SEPARATOR, business_hash, diff_hash, folded, key_text, nested_hash, pack_columns, packed, plain_hash, text_hash, unpack_columns,
)
from tidemark.operators.upsert import latest_per_key, new_rows, update_or_insert

TEXT_TYPES = ("string", "varchar", "char")


def dealt(source: DataFrame, key: str) -> DataFrame:
    """The same rows, dealt by the business hash of a key, which is made after the shuffle and doesn't travel.

    Hubs, satellites and links of rows dealt by the same key meet where they are. All columns travel as one value, so that
    no reader narrows the shuffle for itself and one shuffle serves every reader.
    """
    rest = [c for c in source.columns if c != key]
    if not rest:
        return source.repartition(business_hash([key]))
    rows = source.select(key, F.array(F.struct(*rest)).alias("_rows")).repartition(business_hash([key]))
    return rows.select(key, F.inline_outer("_rows"))


def read_since(df: DataFrame, watermark: Column | None, column: str = "last_updated_dt") -> DataFrame:
    """Source rows at or past a watermark; all rows without a watermark or a time column to hold it against."""
    return df if watermark is None or column not in df.columns else df.filter(F.col(column) >= watermark)


def hub_rows(source: DataFrame, keys: Sequence[str], hash_name: str, load_date: Column, record_source: str, hash_column: Column | None = None) -> DataFrame:
    """One row per business key, hashed.

    A single number key is made distinct before hashing, on the raw column. Text keys can share a hash
    by case or padding, and composite keys by their nulls, so these are made distinct by the text that is
    hashed, or by a given hash column; the least key stands for all, so that reruns agree.
    """
    hashed = business_hash(keys) if hash_column is None else hash_column
    folds = any(source.schema[k].dataType.typeName() in TEXT_TYPES for k in keys)
    if hash_column is None and (folds or len(keys) > 1):
        named = source.select(key_text([folded(k) for k in keys]).alias("_text"), F.struct(*keys).alias("_key"))
        chosen = named.groupBy("_text").agg(F.min("_key").alias("_key")).select(text_hash(F.col("_text")).alias(hash_name), "_key.*")
    elif hash_column is not None:
        chosen = source.select(hashed.alias(hash_name), F.struct(*keys).alias("_key")).groupBy(hash_name).agg(F.min("_key").alias("_key"))
        chosen = chosen.select(hash_name, "_key.*")
    else:
        chosen = source.select(*keys).distinct().select(hashed.alias(hash_name), *keys)
    return chosen.select(hash_name, *keys, load_date.alias("load_date"), F.lit(record_source).alias("record_source"))


def load_hub(hub: DataFrame, rows: DataFrame, hash_name: str, keep_first_load_date: bool = True) -> DataFrame:
    """Next state of the hub: insert-only, or overwriting the stored row of a key."""
    if keep_first_load_date:
        return hub.unionByName(new_rows(hub, rows, [hash_name]))
    return update_or_insert(hub, rows, [hash_name])


def link_rows(
    source: DataFrame, references: Mapping[str, str], link_name: str, load_date: Column, record_source: str, nested: bool = False,
    dealt_by: str | None = None, keep_text: bool = False,
) -> DataFrame:
    """One row per combination of hub references (hash name -> source column).

    ``nested`` hashes the hub hashes instead of the raw foreign keys. Number references are made
    distinct before hashing, so the shuffle carries short keys; only their incomplete rows can
    share a hash, because nulls are skipped in it. Text references are made distinct by the text that is
    hashed, from which their parts are read again; only rows with a null or a separator's character in a
    part bring their parts along.

    ``dealt_by`` names the hash by which the source's rows were dealt (see ``dealt``); the link's rows then stay dealt by it.
    ``keep_text`` adds ``_text`` and ``_odd``, of which ``link_hashes`` makes the hashes again after a shuffle.
    """
    columns = list(references.values())
    key = nested_hash(columns) if nested else business_hash(columns)
    hub_hash = plain_hash if nested else (lambda c: business_hash([c]))

    def hashed(rows: DataFrame) -> DataFrame:
        return rows.select(
            key.alias(link_name),
            *[hub_hash(column).alias(name) for name, column in references.items()],
            load_date.alias("load_date"),
            F.lit(record_source).alias("record_source"),
        )

    if any(source.schema[c].dataType.typeName() in TEXT_TYPES for c in columns):
        if nested:
            return hashed(source).dropDuplicates([link_name])
        parts = [folded(c) for c in columns]
        plain = reduce(lambda a, b: a & b, [p.isNotNull() & ~p.contains(KEY_SEPARATOR[0]) for p in parts])
        odd = F.when(~plain, F.array(*parts))
        text = key_text(parts).alias("_text")
        stamps = [load_date.alias("load_date"), F.lit(record_source).alias("record_source"), *(["_text", "_odd"] if keep_text else [])]
        if dealt_by is None:
            once = source.select(text, odd.alias("_odd")).groupBy("_text").agg(F.min("_odd").alias("_odd"))
            return once.select(*link_hashes(link_name, list(references)), *stamps)
        return _link_in_place(source, references, link_name, dealt_by, text, odd, parts).select(link_name, *references, *stamps)
    distinct = source.select(*columns).distinct()
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return hashed(distinct.filter(complete)).unionByName(hashed(distinct.filter(~complete)).dropDuplicates([link_name]))


def link_part(at: int, text: str = "_text", odd: str = "_odd") -> Column:
    """The text that a link row's reference hash is taken of."""
    return F.get(F.coalesce(F.col(odd), F.split(text, r"\|\|", -1)), F.lit(at))


def link_hashes(link_name: str, names: Sequence[str], text: str = "_text", odd: str = "_odd") -> list[Column]:
    """The hashes of a link row, of the text that its own hash is taken of and the parts that can't be read from it."""
    return [text_hash(F.col(text)).alias(link_name), *[text_hash(link_part(i, text, odd)).alias(n) for i, n in enumerate(names)]]


def _link_in_place(
    source: DataFrame, references: Mapping[str, str], link_name: str, dealt_by: str, text: Column, odd: Column, parts: Sequence[Column],
) -> DataFrame:
    """One row per text where the rows are dealt by one reference's hash.

    A plain row's text says where the row is. Rows that aren't plain go where their text says, to be made distinct with
    plain ones of the same text, and those that are kept then go where their own reference says.
    """
    names, at = list(references), list(references).index(dealt_by)
    # one test of all parts, so that no half of it is pushed into the shuffle that other readers share
    plain = ~F.exists(F.array(*parts), lambda p: p.isNull() | p.contains(KEY_SEPARATOR[0]))
    own = source.select(business_hash([references[dealt_by]]).alias("_place"), text, odd.alias("_odd"), plain.alias("_plain"))
    strays = own.filter(~F.col("_plain")).select("_text", "_odd")
    place = text_hash(F.get(F.split("_text", r"\|\|", -1), F.lit(at)))
    there = strays.repartition(place).select(place.alias("_place"), "_text", "_odd")
    met = own.filter("_plain").select("_place", "_text", "_odd").unionByName(there)
    kept = met.groupBy("_place", "_text").agg(F.min("_odd").alias("_odd")).filter(F.col("_odd").isNull())
    hashes = link_hashes(link_name, names)
    plainly = kept.select(hashes[0], *[F.col("_place").alias(n) if n == dealt_by else h for n, h in zip(names, hashes[1:])], "_text", "_odd")
    home = text_hash(F.get("_odd", F.lit(at)))
    moved = strays.groupBy("_text").agg(F.min("_odd").alias("_odd")).repartition(home)
    oddly = moved.select(hashes[0], *[home.alias(n) if n == dealt_by else h for n, h in zip(names, hashes[1:])], "_text", "_odd")
    return plainly.unionByName(oddly)


def unstored(stored: DataFrame, rows: DataFrame, hash_name: str, made_of: Sequence[str], hash_column: Column) -> DataFrame:
    """Rows whose hash isn't stored, with the columns that all their hashes are made of.

    Only these columns travel, not the hashes: the rows are dealt by their hash before it is made.
    """
    key = packed(hash_column)
    there = rows.select(*made_of).repartition(key).select(key.alias(hash_name), *made_of)
    return there.join(pack_columns(stored.select(hash_name), hash_name), hash_name, "left_anti").drop(hash_name)


def load_link(link: DataFrame, rows: DataFrame, link_name: str) -> DataFrame:
    """Stored link rows and the new ones. Hashes meet in their packed form."""
    hashes = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string" and f.name != "record_source"]
    new = new_rows(pack_columns(link.select(link_name), link_name), pack_columns(rows, *hashes), [link_name])
    return link.unionByName(unpack_columns(new, *hashes).select(*rows.columns))


def with_missing(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Add null columns for tracked attributes the source does not carry."""
    types = types or {}
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(types.get(c, "string")) for c in absent}) if absent else df


def satellite_rows(
    source: DataFrame,
    hub_key: str,
    hash_name: str,
    tracked: Sequence[str],
    load_date: Column,
    record_source: str,
    types: Mapping[str, str] | None = None,
    as_text: bool = False,
    hash_column: Column | None = None,
) -> DataFrame:
    """Attribute versions with their diff hash, in source types, declared types or text."""
    types = types or {}
    full = with_missing(source, tracked, types)

    def payload(name: str) -> Column:
        if as_text:
            return F.col(name).cast("string").alias(name)
        return (F.col(name).try_cast(types[name]) if name in types else F.col(name)).alias(name)

    return full.select(
        (business_hash([hub_key]) if hash_column is None else hash_column).alias(hash_name),
        load_date.alias("load_date"),
        diff_hash(tracked).alias("diff_hk"),
        *[payload(c) for c in tracked],
        F.lit(record_source).alias("record_source"),
    )


def current_versions(satellite: DataFrame, hash_name: str, in_place: bool = False) -> DataFrame:
    """Latest version of every key. Hashes are shuffled in their packed form; a key that is packed already stays so.

    ``in_place``: the versions come dealt by the key, so nothing is shuffled.
    """
    if in_place:
        return latest_per_key(satellite, [hash_name], ["load_date", "diff_hk"])
    hashes = [c for c in (hash_name, "diff_hk") if satellite.schema[c].dataType.typeName() == "string"]
    return unpack_columns(latest_per_key(pack_columns(satellite, *hashes), [hash_name], ["load_date", "diff_hk"]), *hashes)


def changed_versions(satellite: DataFrame, rows: DataFrame, hash_name: str) -> DataFrame:
    """Rows that differ from the key's latest stored version; a return to an old value counts."""
    hashes = (hash_name, "diff_hk")
    latest = current_versions(pack_columns(satellite.select(hash_name, "load_date", "diff_hk"), *hashes), hash_name).select(
        hash_name, F.col("diff_hk").alias("_stored")
    )
    changed = (
        pack_columns(rows, *hashes).join(latest, hash_name, "left")
        .filter(F.col("_stored").isNull() | (F.col("diff_hk") != F.col("_stored")))
    )
    return unpack_columns(changed, *hashes).select(*rows.columns)


def unseen_versions(satellite: DataFrame, rows: DataFrame, hash_name: str) -> DataFrame:
    """Rows whose attributes never occurred for the key before."""
    hashes = (hash_name, "diff_hk")
    seen = pack_columns(satellite.select(*hashes), *hashes).distinct()
    return unpack_columns(pack_columns(rows, *hashes).join(seen, list(hashes), "left_anti"), *hashes).select(*rows.columns)


def key_history(satellite: DataFrame, hash_name: str, key: Column | None = None) -> DataFrame:
    """Versions in load order, for one key or for all."""
    chosen = satellite if key is None else satellite.filter(F.col(hash_name) == key)
    return chosen.orderBy(hash_name, "load_date")


def duplicate_hashes(hub: DataFrame, hash_name: str) -> DataFrame:
    """Hash keys stored more than once."""
    return hub.groupBy(hash_name).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def missing_parents(link: DataFrame, link_name: str, hubs: Mapping[str, DataFrame]) -> DataFrame:
    """Link rows whose hub key is null or absent, one row per offending reference."""
    parts = []
    for column, hub in hubs.items():
        absent = link.select(packed(link_name).alias(link_name), packed(column).alias("hub_hash")).join(
            hub.select(packed(column).alias("hub_hash")).distinct(), "hub_hash", "left_anti"
        )
        parts.append(unpack_columns(absent, link_name, "hub_hash").select(link_name, F.lit(column).alias("reference"), "hub_hash"))
    return reduce(DataFrame.unionByName, parts)


def orphan_versions(satellite: DataFrame, hub: DataFrame, hash_name: str) -> DataFrame:
    """Satellite keys that are in no hub, with how many versions each has."""
    return (
        satellite.groupBy(hash_name)
        .agg(F.count(F.lit(1)).alias("n_versions"))
        .join(hub.select(hash_name), hash_name, "left_anti")
    )


def load_log(tables: Mapping[str, tuple[str, DataFrame]], loaded_at: Column) -> DataFrame:
    """Row count of every vault table as log rows (name -> (kind, table))."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("table_type"), "row_count",
            F.when(F.col("row_count") > 0, "PASS").otherwise("FAIL").alias("status"),
            loaded_at.alias("loaded_at"),
        )
        for name, (kind, df) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def key_profile(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows, non-null and distinct counts per candidate key column, in one grouped pass.

    Values are first reduced to one row per (column, value) with map-side combining, so a
    frequent value costs no more than a rare one.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns
    ])).alias("p")).select("p.*")
    values = pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("n_present"),
        F.count("v").alias("n_distinct"),
    ).select(F.lit(table).alias("table_name"), "*")


def containment(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Share of the child's distinct non-null values found among the parent's values."""
    values = child.select(F.col(column).alias("v")).filter("v is not null").distinct()
    found = values.join(
        parent.select(F.col(parent_column).alias("v")).distinct().withColumn("hit", F.lit(1)), "v", "left"
    )
    return found.agg(F.count(F.lit(1)).alias("n_values"), F.count("hit").alias("n_found"))


#: Nominal entries of a column's sketch, least estimated containment of a candidate, and expected common entries below
#: which an estimate says nothing and the exact check decides.
SKETCH_ENTRIES, LIKELY, TOO_FEW = 4096, 0.8, 30
#: Types whose values name things.
FAMILIES = {"byte": "integer", "short": "integer", "integer": "integer", "long": "integer", "string": "string"}


def column_sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, values and a mergeable sketch of the distinct values of every integer and text column, in one pass a table."""
    def named(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, FAMILIES[f.dataType.typeName()]) for f in df.schema.fields if f.dataType.typeName() in FAMILIES]

    def of(name: str, df: DataFrame) -> DataFrame:
        columns = named(df)
        row = df.agg(F.array(*[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(family).alias("family"), F.count(F.lit(1)).alias("n_rows"), F.count(f"`{c}`").alias("n_values"),
                F.theta_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_ENTRIES.bit_length() - 1).alias("sketch"))
            for c, family in columns]).alias("columns"))
        return row.select(F.lit(name).alias("table_name"), F.inline("columns"))

    return reduce(DataFrame.unionByName, [of(name, df) for name, df in tables.items() if named(df)])


def reference_candidates(sketches: DataFrame) -> DataFrame:
    """Pairs of columns, child and parent, that the sketches don't rule out.

    A parent has no nulls and about as many distinct values as rows. A child's estimated share of values among the
    parent's must be likely, or too few entries of the child are expected in the parent's sketch to tell.
    """
    rated = sketches.withColumn("n_distinct", F.theta_sketch_estimate("sketch")).filter("n_distinct > 0")
    parent = rated.filter((F.col("n_rows") == F.col("n_values")) & (F.col("n_distinct") >= 0.9 * F.col("n_rows")))
    parent = parent.select("family", F.col("table_name").alias("parent"), F.col("column_name").alias("parent_column"), F.col("sketch").alias("_p"), F.col("n_distinct").alias("_n"))
    both = rated.join(parent, "family").filter("not (table_name = parent and column_name = parent_column)")
    share = F.theta_sketch_estimate(F.theta_intersection("sketch", "_p")) / F.col("n_distinct")
    expected = F.col("n_distinct") * F.least(F.lit(1.0), SKETCH_ENTRIES / F.greatest(F.col("_n"), F.col("n_distinct")))
    return both.filter((share >= LIKELY) | (expected < TOO_FEW)).select("table_name", "column_name", "parent", "parent_column")


def find_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns all of whose values are among those of a unique, never-null column, found without any names given.

    Sketches of all columns choose the candidates, at most the pairs of columns, which the driver holds; one exact pass
    checks them: distinct values of all candidate children meet those of all candidate parents in one join.
    """
    spark = next(iter(tables.values())).sparkSession
    pairs = [tuple(r) for r in reference_candidates(column_sketches(tables)).collect()]
    wanted = spark.createDataFrame(pairs, "table_name string, column_name string, parent string, parent_column string")

    def values(columns: set[tuple[str, str]]) -> DataFrame:
        """Each column's values with how often they occur; nulls are left out."""
        def of(name: str) -> DataFrame:
            own = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for t, c in sorted(columns) if t == name])
            return tables[name].select(F.lit(name).alias("table_name"), F.inline(own)).filter("v is not null")

        none = spark.createDataFrame([], "table_name string, column_name string, v string")
        each = reduce(DataFrame.unionByName, [of(name) for name in sorted({t for t, _ in columns})], none)
        return each.groupBy("table_name", "column_name", "v").agg(F.count(F.lit(1)).alias("n"))

    child = values({p[:2] for p in pairs}).drop("n").join(wanted, ["table_name", "column_name"])
    held = values({p[2:] for p in pairs}).withColumnsRenamed({"table_name": "parent", "column_name": "parent_column"})
    found = child.join(held, ["parent", "parent_column", "v"], "left").groupBy("table_name", "column_name", "parent", "parent_column").agg(
        F.count(F.lit(1)).alias("n_values"), F.count("n").alias("_found"))
    unique = held.groupBy("parent", "parent_column").agg(F.max("n").alias("_most"))
    good = found.filter(F.col("n_values") == F.col("_found")).join(unique.filter("_most = 1"), ["parent", "parent_column"])
    return good.select("table_name", "column_name", "parent", "parent_column", "n_values")


def suggest_entities(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    references: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """Suggest hub, junction or plain table, and links, from measured keys and containment.

    ``keys`` names candidate key columns per table, ``references`` lists
    (child, column, parent, parent column) to measure. A unique, never-null key makes a hub; a
    table without one but with two or more contained references is a junction.
    """
    profiles = reduce(DataFrame.unionByName, [key_profile(tables[t], t, cols) for t, cols in keys.items()])
    uniqueness = profiles.groupBy("table_name").agg(
        F.max(((F.col("n_distinct") == F.col("n_rows")) & (F.col("n_present") == F.col("n_rows"))).cast("int")).alias("has_key")
    )
    measured = reduce(
        DataFrame.unionByName,
        [
            containment(tables[child], column, tables[parent], parent_column).select(
                F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"),
                (F.col("n_found") == F.col("n_values")).alias("contained"),
            )
            for child, column, parent, parent_column in references
        ],
    )
    kept = measured.filter("contained")
    per_table = kept.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_refs"))
    entities = uniqueness.join(per_table, "table_name", "left").select(
        "table_name",
        F.lit("").alias("column_name"),
        F.lit("").alias("parent"),
        F.when(F.col("has_key") == 1, "hub")
        .when(F.coalesce("n_refs", F.lit(0)) >= 2, "junction")
        .otherwise("review")
        .alias("suggestion"),
    )
    links = kept.select("table_name", "column_name", "parent", F.lit("link").alias("suggestion"))
    return entities.unionByName(links)
