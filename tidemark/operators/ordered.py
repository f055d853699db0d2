"""Neighbours, running totals and global ranks in an order that crosses tasks.

Rows are dealt to ranges of (group, order columns, all further columns), compared as the values they are. The ranges' limits
are quantiles of a sample of distinct rows, drawn by the hash of a row, that the same plan reads as a scalar subquery; so no job
runs while a plan is built, and the plan is the same at every size. A group that holds a third of the rows, a third of equal
or null order values and long common prefixes are spread over ranges like any others. Equal rows are counted into one before
that, map-side, and told apart again at the end.

What a range needs from the ranges before it is one row a range: the last row, or its group's total. These few rows, at most
``RANGES_A_PARTITION`` for each shuffle partition, are carried by a window and joined back by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Ranges for each shuffle partition, and sampled rows for each range.
RANGES_A_PARTITION = 4
SAMPLED_A_RANGE = 8


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with ``_copies``. Columns must be comparable, so maps are no payload."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def ranged(rows: DataFrame, group_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Add ``_key``, the row's place as a struct, and ``_range``, the number of its range, to distinct rows."""
    rest = [c for c in rows.columns if c not in (*group_by, *order_by, "_copies")]
    names = [*dict.fromkeys([*group_by, *order_by]), *rest]
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)])
    ranges = RANGES_A_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_key", key)
    read = keyed.filter("_copies > 0") if "_copies" in rows.columns else keyed  # the same shuffle serves all readings
    sample = read.orderBy(F.xxhash64("_key")).limit(ranges * SAMPLED_A_RANGE)
    limits = sample.agg(F.filter(
        F.array_sort(F.collect_list("_key")), lambda _, i: (i + 1) % SAMPLED_A_RANGE == 0)).scalar()
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(ranges.bit_length()))])

    def halved(at: Column, step: Column) -> Column:
        return F.when(F.get("_limits", at + step - 1) < F.col("_key"), at + step).otherwise(at)

    return keyed.withColumn("_limits", limits).withColumn("_range", F.aggregate(halves, F.lit(0), halved)).drop("_limits")


def _same_group(group_by: Sequence[str], side: str) -> Column:
    same = F.lit(True)
    for i, c in enumerate(group_by):
        same = same & F.col(f"{side}.k{i}").eqNullSafe(F.col(f"`{c}`"))
    return same


def with_neighbour(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], column: str, name: str, direction: str = "previous") -> DataFrame:
    """Add the column's value from the previous or next row of the group; rows equal in order are taken by their other columns.

    Null order values sort first, as in an ascending window.
    """
    forward = direction == "previous"
    rows = ranged(_counted(df), group_by, order_by)
    shift, last = (F.lag, F.max) if forward else (F.lead, F.min)
    value = F.struct("_key", F.col(f"`{column}`").alias("v"))
    edges = rows.groupBy("_range").agg(last(value).alias("_edge"))
    carried = edges.select("_range", shift("_edge").over(Window.orderBy("_range")).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy("_key")
    near = rows.join(carried, "_range", "left").withColumn("_near", F.coalesce(shift(value).over(inside), F.col("_carried")))
    found = near.withColumn("_found", F.when(_same_group(group_by, "_near._key"), F.col("_near.v")))
    # the copies of a row follow one another: one of them looks beyond, the others at a copy
    each = found.select(*df.columns, "_found", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_i"))
    return each.select(*df.columns, F.when(F.col("_i") == 1, F.col("_found")).otherwise(F.col(f"`{column}`")).alias(name))


def with_running_total(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], weight: Column, name: str, distinct: bool = False,
) -> DataFrame:
    """Add the running total of a weight within each group; ``distinct`` promises that no row occurs twice."""
    counted = df.withColumn("_copies", F.lit(1).cast("bigint")) if distinct else _counted(df)
    rows = ranged(counted, group_by, order_by).withColumn("_w", weight)
    group = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(group_by)], F.lit(0).alias("_all"))
    tails = rows.groupBy("_range", group.alias("_group")).agg(F.sum(F.col("_w") * F.col("_copies")).alias("_tail"))
    edges = tails.groupBy("_range").agg(F.max(F.struct("_group", "_tail")).alias("_edge")).select("_range", "_edge._group", "_edge._tail")
    upto = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = edges.withColumn("_sum", F.sum("_tail").over(upto))
    by_range = Window.orderBy("_range")
    carried = totals.select("_range", F.lag(F.struct("_group", "_sum")).over(by_range).alias("_carried"))
    inside = Window.partitionBy("_range", *group_by).orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(carried, "_range", "left")
    before = F.when(_same_group(group_by, "_carried._group"), F.col("_carried._sum"))
    summed = joined.withColumn("_upto", F.sum(F.col("_w") * F.col("_copies")).over(inside) + F.coalesce(before, F.lit(0)))
    if distinct:
        return summed.select(*df.columns, F.col("_upto").alias(name))
    each = summed.select(*df.columns, "_upto", "_w", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)).alias("_i"))
    return each.select(*df.columns, (F.col("_upto") - F.col("_w") * F.col("_i")).alias(name))


def with_row_number(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], name: str, distinct: bool = False) -> DataFrame:
    """Add the ascending row number within each group; rows equal in order are numbered by their other columns."""
    return with_running_total(df, group_by, order_by, F.lit(1).cast("bigint"), name, distinct)


def dense_rank_desc(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Global dense rank, highest value first, nulls last: the place of the value among the distinct ones.

    Only the measure is computed for the ranks, and they are joined back by value.
    """
    values = df.select(F.col(measure).alias("_m")).distinct()
    ranks = with_row_number(values, [], ["_m"], "_place", distinct=True)
    top = values.select(F.count(F.lit(1))).scalar()
    ranks = ranks.select("_m", (top - F.col("_place") + 1).cast("int").alias(name))
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_m"))).select(*df.columns, name)
