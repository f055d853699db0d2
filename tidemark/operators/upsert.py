"""Latest-per-key selection and keyed merges as DataFrame functions.

A merge takes the current table and a batch and gives the next table, so it runs the same in
batch, in a streaming micro-batch and against an oracle. Writers swap the result in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of every key.

    The ``= 1`` filter lets Spark cut each key to one row per map task before the shuffle,
    so a key holding a large share of the table does not land in one task.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """Latest row of every key by descending order columns."""
    return keep_first(df, keys, [F.col(c).desc() for c in order_columns])


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    event_time: str = "event_time",
    op: str = "op",
    order_column: str | Sequence[str] | None = None,
    keep_first_insert_time: bool = True,
) -> DataFrame:
    """Apply one change per key: update, delete on op ``d``, insert unless delete.

    Only columns the target has are written. ``last_updated_dt`` takes the event time, and
    ``last_inserted_dt`` keeps its first value unless ``keep_first_insert_time`` is off. With ``order_column`` (one
    or several, present on both sides, compared in turn) a change older than the stored row is ignored, so late batches
    cannot overwrite newer state; a null on either side doesn't hold a change back.
    """
    stamps = ("last_inserted_dt", "last_updated_dt")
    wanted = [c for c in (columns or changes.columns) if c in target.columns and c not in stamps and c not in keys]
    order = [order_column] if isinstance(order_column, str) else list(order_column or ())
    needed = list(dict.fromkeys([*keys, *wanted, event_time, op, *order]))
    old = lambda name: F.col(f"_t_{name}")
    new = lambda name: F.col(f"_s_{name}")

    left = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_target"))
    right = changes.select(*[F.col(c).alias(f"_s_{c}") for c in needed], F.lit(True).alias("_in_changes"))
    joined = left.join(right, [old(k) == new(k) for k in keys], "full_outer")

    stored = F.col("_in_target").isNotNull()
    applies = F.col("_in_changes").isNotNull()
    if order:
        newer = F.lit(True)
        for c in reversed(order):
            newer = F.coalesce((new(c) > old(c)) | ((new(c) == old(c)) & newer), F.lit(True))
        applies = applies & (~stored | newer)
    deletes = applies & F.coalesce(new(op) == "d", F.lit(False))

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(old(name), new(name))
        if name == "last_inserted_dt" and keep_first_insert_time:
            return F.when(stored, old(name)).otherwise(new(event_time))
        if name == "last_inserted_dt":
            return F.when(applies, F.coalesce(new(event_time), old(name))).otherwise(old(name))
        if name == "last_updated_dt":
            return F.when(applies, new(event_time)).otherwise(old(name))
        return F.when(applies, new(name)).otherwise(old(name)) if name in wanted else old(name)

    return joined.filter(~deletes & (stored | applies)).select(*[value(c).alias(c) for c in target.columns])


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks; source keys must be unique."""
    return target.unionByName(new_rows(target, source, keys))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target: what an append would write."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def update_or_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; all other target rows stay."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns on the rows that meet a condition."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def refresh_since(target: DataFrame, source: DataFrame, keys: Sequence[str], watermark: str) -> DataFrame:
    """Merge only the source rows at or past the target's high-water mark.

    The mark is a scalar subquery, so it is pushed to the source scan as a filter.
    """
    mark = target.select(
        F.coalesce(F.max(watermark), F.lit("1900-01-01").cast(target.schema[watermark].dataType))
    ).scalar()
    return update_or_insert(target, source.filter(F.col(watermark) >= mark), keys)
