"""Assertions that compare tables, keys, order and recency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import add_periods, boundaries_between, truncate
from tidemark.operators.assertions.core import (
    ALL_MISSING, Expr, as_column, bounds, equal_expression, failing, keep_unless_missing, one_row, restrict,
)
from tidemark.operators.ordered import with_neighbour
from tidemark.operators.relational import date_spine

GroupBy = Sequence[str] | None

# Fixed value: newest time assumed for a table without rows.
NO_DATA_TIME = "1970-01-01"


def cardinality_equality(df: DataFrame, column: str, other: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ between two columns."""
    a = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_left"))
    b = other.groupBy(F.col(field).alias("_value")).agg(F.count(F.lit(1)).alias("n_right"))
    joined = a.join(b, F.col("value").eqNullSafe(F.col("_value")), "full_outer")
    return joined.select(
        F.coalesce("value", "_value").alias("value"),
        F.coalesce("n_left", F.lit(0)).alias("n_left"),
        F.coalesce("n_right", F.lit(0)).alias("n_right"),
    ).filter("n_left <> n_right")


def _count_pairs(df: DataFrame, compare: DataFrame, group_by: GroupBy) -> DataFrame:
    keys = list(group_by or [])
    a = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_a"))
    b = compare.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_b"))
    paired = a.join(b, keys, "full_outer") if keys else one_row(a, b)
    return paired.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("count_a", "count_b")])


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: GroupBy = None) -> DataFrame:
    """Groups whose row counts differ; a group missing on one side counts zero there."""
    return _count_pairs(df, compare, group_by).withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))).filter(
        "diff_count > 0"
    )


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: GroupBy = None) -> DataFrame:
    """Groups that do not have fewer rows than the other table's."""
    delta = F.when(F.col("count_a") > F.col("count_b"), F.col("count_a") - F.col("count_b")).when(
        F.col("count_a") == F.col("count_b"), 1
    ).otherwise(0)
    return _count_pairs(df, compare, group_by).withColumn("row_count_delta", delta).filter("row_count_delta > 0")


def equality(
    df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None, exclude_columns: Sequence[str] = (),
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows found in only one of two tables, labelled with the side."""
    names = [c for c in (compare_columns or df.columns) if c not in set(exclude_columns)]
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double", "decimal")}

    def shaped(frame: DataFrame) -> DataFrame:
        return frame.select(*[
            (F.round(F.col(c), precision) if precision is not None and c in numeric else F.col(c)).alias(c) for c in names
        ])

    # One shuffle: both tables are marked and combined by row, copies map-side.
    marked = shaped(df).withColumn("_in_a", F.lit(True)).unionByName(shaped(compare).withColumn("_in_a", F.lit(False)))
    sides = marked.groupBy(*names).agg(F.bool_or("_in_a").alias("_any_a"), F.bool_and("_in_a").alias("_all_a"))
    found = sides.where(F.col("_any_a") == F.col("_all_a"))
    return found.select(*names, F.when(F.col("_any_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff"))


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def expect_compound_columns_to_be_unique(df: DataFrame, columns: Sequence[str], ignore_row_if: str = ALL_MISSING, row_condition: Expr | None = None) -> DataFrame:
    rows = restrict(df, row_condition).filter(keep_unless_missing(columns, ignore_row_if))
    return unique_combination_of_columns(rows, columns)


def expect_column_values_to_be_unique(df: DataFrame, column: str, row_condition: Expr | None = None) -> DataFrame:
    return expect_compound_columns_to_be_unique(df, [column], row_condition=row_condition)


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str, from_condition: Expr = "1=1", to_condition: Expr = "1=1") -> DataFrame:
    """Values that have no partner, each once with its row count, under conditions on both sides."""
    child = df.filter(as_column(from_condition)).filter(F.col(column).isNotNull())
    parent = to.filter(as_column(to_condition)).select(F.col(field).alias("from_value"))
    values = child.groupBy(F.col(column).alias("from_value")).agg(F.count(F.lit(1)).alias("n_records"))
    return values.join(parent, "from_value", "left_anti")


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    return relationships_where(df, column, to, field)


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: GroupBy = None, gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty or reversed, or that break the gap rule with the next range."""
    rules = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n, "required": lambda u, n: u < n}
    if gaps not in rules:
        raise ValueError(f"gaps must be one of {sorted(rules)}")
    keys = list(partition_by or [])
    ranges = df.select(*keys, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound")).withColumn(
        "_own", F.struct(F.col("lower_bound").alias("v"))
    )
    paired = with_neighbour(ranges, keys, ["lower_bound", "upper_bound"], "_own", "_next", "next")
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("_next.v")
    proper = F.coalesce(low <= high if zero_length_range_allowed else low < high, F.lit(False))
    apart = F.coalesce(rules[gaps](high, following), F.col("_next").isNull())
    return paired.filter(~(proper & apart)).select(*keys, "lower_bound", "upper_bound", following.alias("next_lower_bound"))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: GroupBy = None) -> DataFrame:
    """Values that do not follow their predecessor by exactly the interval.

    Equal values are counted together first; a repeated value fails once with its count.
    """
    keys = list(group_by or [])
    values = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n_rows"))
    paired = with_neighbour(values, keys, [column], column, "previous_value")
    expected = add_periods(F.col("previous_value"), datepart, interval) if datepart else F.col("previous_value") + interval
    breaks = F.coalesce(F.col(column) != expected, F.lit(False))
    repeats = F.col("n_rows") > 1
    return paired.filter(breaks | repeats).select(*keys, column, "previous_value", "n_rows")


def _monotonic(df: DataFrame, column: str, sort_column: str | None, strictly: bool, row_condition, group_by: GroupBy, step, sign: int) -> DataFrame:
    keys = list(group_by or [])
    order = sort_column or column
    rows = restrict(df, row_condition).select(*keys, F.col(order).alias("sort_column"), F.col(column).alias("value_field"))
    paired = with_neighbour(rows, keys, ["sort_column", "value_field"], "value_field", "value_field_lag")
    value, before = F.col("value_field"), F.col("value_field_lag")
    ahead = {(1, True): value > before, (1, False): value >= before, (-1, True): value < before, (-1, False): value <= before}
    good = ahead[(sign, strictly)]
    if step is not None:
        good = good & ((value - before) == F.lit(sign * step))
    return failing(paired.filter(before.isNotNull()), good)


def expect_column_values_to_be_increasing(df: DataFrame, column: str, sort_column: str | None = None, strictly: bool = True, row_condition: Expr | None = None, group_by: GroupBy = None, step=None) -> DataFrame:
    """Rows not above their predecessor in sort order; equal sort values are taken by value."""
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, step, 1)


def expect_column_values_to_be_decreasing(df: DataFrame, column: str, sort_column: str | None = None, strictly: bool = True, row_condition: Expr | None = None, group_by: GroupBy = None, step=None) -> DataFrame:
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, step, -1)


def expect_column_values_to_have_consistent_casing(df: DataFrame, column: str, display_inconsistent_columns: bool = False) -> DataFrame:
    """Values that occur in more than one casing, or just the two distinct counts."""
    values = df.select(F.col(column).alias("v")).distinct()
    folded = values.filter("v is not null").groupBy(F.lower("v").alias("inconsistent_columns")).agg(
        F.count(F.lit(1)).alias("set_count")
    )
    if display_inconsistent_columns:
        return folded.filter("set_count > 1")
    return folded.agg(
        F.sum("set_count").alias("set_count"), F.count(F.lit(1)).alias("set_count_case_insensitive")
    ).filter("set_count <> set_count_case_insensitive")


def expect_row_values_to_have_data_for_every_n_datepart(
    df: DataFrame, date_column: str, date_part: str = "day", interval: int | None = None, row_condition: Expr | None = None,
    exclusion_condition: Expr | None = None, test_start_date: str | None = None, test_end_date: str | None = None,
) -> DataFrame:
    """Periods between two dates (or the data's own range, end left out) without any row."""
    rows = restrict(df, row_condition)
    day = F.col(date_column).cast("date")
    bounds_row = rows.agg(F.min(day).alias("_s"), F.max(day).alias("_e"))
    if test_start_date:
        bounds_row = bounds_row.withColumn("_s", F.lit(test_start_date).cast("date"))
    if test_end_date:
        bounds_row = bounds_row.withColumn("_e", F.lit(test_end_date).cast("date"))
    name = f"date_{date_part}"
    spine = date_spine(bounds_row, date_part, "_s", "_e", name)
    start = F.lit(test_start_date).cast("timestamp_ntz") if test_start_date else rows.select(F.min(day)).scalar().cast("timestamp_ntz")
    moment = truncate(F.col(date_column), date_part)
    if interval:
        origin = F.col("_s").cast("timestamp_ntz")
        spine = spine.filter(boundaries_between(origin, F.col(name), date_part) % interval == 0)
        late = (boundaries_between(start, F.col(date_column), date_part) % interval).cast("int")
        moment = add_periods(moment, date_part, -late)
    counts = rows.groupBy(moment.alias(name)).agg(F.count(F.lit(1)).alias("row_cnt"))
    missing = spine.select(name).join(counts, name, "left_anti").withColumns({"is_missing": F.lit(True), "row_cnt": F.lit(0)})
    return restrict(missing, exclusion_condition)


def recency(df: DataFrame, column: str, datepart: str, interval: int, as_of: Column, ignore_time_component: bool = False, group_by: GroupBy = None) -> DataFrame:
    """Groups (or the table) whose newest value is older than the limit, or absent."""
    limit = add_periods(as_of, datepart, -interval)
    newest = F.max(column)
    if ignore_time_component:
        limit, newest = limit.cast("date"), newest.cast("date")
    tested = df.groupBy(*(group_by or [])).agg(newest.alias("most_recent")).withColumn("threshold", limit)
    return tested.filter(F.col("most_recent").isNull() | (F.col("most_recent") < F.col("threshold")))


def expect_row_values_to_have_recent_data(df: DataFrame, column: str, datepart: str, interval: int, as_of: Column, row_condition: Expr | None = None) -> DataFrame:
    """The newest past time, if it is too old; times after ``as_of`` are ignored."""
    past = restrict(df, row_condition).filter(F.col(column) <= as_of)
    limit = add_periods(as_of, datepart, -interval)
    return past.agg(F.max(column).alias("max_timestamp")).filter(
        F.coalesce("max_timestamp", F.lit(NO_DATA_TIME).cast("timestamp_ntz")) < limit
    )


def expect_grouped_row_values_to_have_recent_data(df: DataFrame, group_by: Sequence[str], column: str, datepart: str, interval: int, as_of: Column, row_condition: Expr | None = None) -> DataFrame:
    past = restrict(df, row_condition).filter(F.col(column) <= as_of)
    return past.groupBy(*group_by).agg(F.max(column).alias("latest_timestamp")).filter(
        F.col("latest_timestamp") < add_periods(as_of, datepart, -interval)
    )


def expect_table_aggregation_to_equal_other_table(df: DataFrame, expression: Expr, compare: DataFrame, **options) -> DataFrame:
    return equal_expression(df, expression, compare, **options)


def expect_table_row_count_to_be_between(df: DataFrame, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    counted = restrict(df, row_condition).groupBy(*(group_by or [])).agg(F.count(F.lit(1)).alias("expression"))
    return failing(counted, bounds(F.col("expression"), min_value, max_value, strictly))


def expect_table_row_count_to_equal(df: DataFrame, value: int, group_by: GroupBy = None, row_condition: Expr | None = None) -> DataFrame:
    counted = restrict(df, row_condition).groupBy(*(group_by or [])).agg(F.count(F.lit(1)).alias("expression"))
    return counted.filter(F.col("expression") != value)


def expect_table_row_count_to_equal_other_table(
    df: DataFrame, compare: DataFrame, group_by: GroupBy = None, compare_group_by: GroupBy = None, factor: float = 1,
    row_condition: Expr | None = None, compare_row_condition: Expr | None = None,
) -> DataFrame:
    """Groups whose row count is not the other table's count times a factor."""
    count = F.count(F.lit(1))
    return equal_expression(
        df, count, compare, count * F.lit(factor), group_by=group_by, compare_group_by=compare_group_by,
        row_condition=row_condition, compare_row_condition=compare_row_condition,
    )


def expect_table_row_count_to_equal_other_table_times_factor(df: DataFrame, compare: DataFrame, factor: float, **options) -> DataFrame:
    return expect_table_row_count_to_equal_other_table(df, compare, factor=factor, **options)
