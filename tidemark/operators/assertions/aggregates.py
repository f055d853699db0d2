"""Assertions on aggregates, distributions and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import add_periods, truncate
from tidemark.operators.assertions.core import Expr, bounds, equal_expression, expression_between, failing, restrict
from tidemark.operators.ordered import with_running_total

GroupBy = Sequence[str] | None


def _distinct_count(df: DataFrame, column: str, group_by: GroupBy, row_condition: Expr | None) -> DataFrame:
    return restrict(df, row_condition).groupBy(*(group_by or [])).agg(F.count_distinct(F.col(column)).alias("expression"))


def expect_column_distinct_count_to_equal(df: DataFrame, column: str, value: int, group_by: GroupBy = None, row_condition: Expr | None = None) -> DataFrame:
    return _distinct_count(df, column, group_by, row_condition).filter(F.col("expression") != value)


def expect_column_distinct_count_to_be_greater_than(df: DataFrame, column: str, value: int, group_by: GroupBy = None, row_condition: Expr | None = None) -> DataFrame:
    return _distinct_count(df, column, group_by, row_condition).filter(F.col("expression") <= value)


def expect_column_distinct_count_to_be_less_than(df: DataFrame, column: str, value: int, group_by: GroupBy = None, row_condition: Expr | None = None) -> DataFrame:
    return _distinct_count(df, column, group_by, row_condition).filter(F.col("expression") >= value)


def expect_column_distinct_count_to_equal_other_table(df: DataFrame, column: str, compare: DataFrame, compare_column: str, row_condition: Expr | None = None, compare_row_condition: Expr | None = None) -> DataFrame:
    return equal_expression(
        df, F.count_distinct(F.col(column)), compare, F.count_distinct(F.col(compare_column)),
        row_condition=row_condition, compare_row_condition=compare_row_condition,
    )


def _set_rows(df: DataFrame, column: str, value_set: Sequence) -> DataFrame:
    kind = df.schema[column].dataType
    return df.sparkSession.range(1).select(
        F.explode(F.array_distinct(F.array(*[F.lit(v).cast(kind) for v in value_set]))).alias("value_field")
    )


def _outside(rows: DataFrame, column: str, value_set: Sequence) -> DataFrame:
    return rows.filter(~F.col(column).isin(*value_set)).select(F.col(column).alias("value_field")).distinct()


def _absent(rows: DataFrame, column: str, value_set: Sequence) -> DataFrame:
    found = rows.filter(F.col(column).isin(*value_set)).select(F.col(column).alias("value_field")).distinct()
    return _set_rows(rows, column, value_set).join(found, "value_field", "left_anti")


def expect_column_distinct_values_to_be_in_set(df: DataFrame, column: str, value_set: Sequence, row_condition: Expr | None = None) -> DataFrame:
    """Values that occur but are not in the set."""
    return _outside(restrict(df, row_condition), column, value_set)


def expect_column_distinct_values_to_contain_set(df: DataFrame, column: str, value_set: Sequence, row_condition: Expr | None = None) -> DataFrame:
    """Values of the set that never occur."""
    return _absent(restrict(df, row_condition), column, value_set)


def expect_column_distinct_values_to_equal_set(df: DataFrame, column: str, value_set: Sequence, row_condition: Expr | None = None) -> DataFrame:
    """Values found on one side only."""
    rows = restrict(df, row_condition)
    return _outside(rows, column, value_set).unionByName(_absent(rows, column, value_set))


def expect_column_min_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return expression_between(df, F.min(column), min_value, max_value, group_by, row_condition, strictly)


def expect_column_max_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return expression_between(df, F.max(column), min_value, max_value, group_by, row_condition, strictly)


def expect_column_mean_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return expression_between(df, F.avg(column), min_value, max_value, group_by, row_condition, strictly)


def expect_column_sum_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return expression_between(df, F.sum(column), min_value, max_value, group_by, row_condition, strictly)


def expect_column_stdev_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    """Sample standard deviation."""
    return expression_between(df, F.stddev_samp(column), min_value, max_value, group_by, row_condition, strictly)


def exact_quantile(df: DataFrame, column: str, quantile: float, group_by: GroupBy = None) -> DataFrame:
    """Interpolated quantile per group, from value counts.

    Values are reduced to (group, value, count) with map-side combining, then the two values
    around the target position are located by a running count that splits large groups, so no
    task ever holds all values of a group.
    """
    keys = list(group_by or [])
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    running = with_running_total(counts, keys, ["_v"], F.col("_n"), "_upto", distinct=True)
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_rows"))
        placed = running.join(totals, keys)
    else:
        placed = running.withColumn("_rows", counts.select(F.sum("_n")).scalar())
    position = (F.col("_rows") - 1) * F.lit(float(quantile))
    value = F.col("_v").cast("double")
    ends = placed.groupBy(*keys).agg(
        F.min(F.when(F.col("_upto") > F.floor(position), value)).alias("_low"),
        F.min(F.when(F.col("_upto") > F.ceil(position), value)).alias("_high"),
        F.max(position - F.floor(position)).alias("_share"),
    )
    return ends.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("expression"))


def expect_column_quantile_values_to_be_between(df: DataFrame, column: str, quantile: float, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return failing(
        exact_quantile(restrict(df, row_condition), column, quantile, group_by),
        bounds(F.col("expression"), min_value, max_value, strictly),
    )


def expect_column_median_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return expect_column_quantile_values_to_be_between(df, column, 0.5, min_value, max_value, group_by, row_condition, strictly)


def most_common_value(df: DataFrame, column: str, rank: int = 1) -> DataFrame:
    """The rank-th most common value; ties go to the smaller value."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    return counted.orderBy(F.col("value_count").desc(), F.col("value_field")).offset(rank - 1).limit(1)


def expect_column_most_common_value_to_be_in_set(df: DataFrame, column: str, value_set: Sequence, top_n: int = 1, row_condition: Expr | None = None) -> DataFrame:
    """The top_n-th most common value, if it is not in the set."""
    return most_common_value(restrict(df, row_condition), column, top_n).filter(
        ~F.col("value_field").isin(*value_set)
    ).select("value_field")


def _uniqueness(df: DataFrame, column: str, group_by: GroupBy, row_condition: Expr | None) -> DataFrame:
    keys = list(group_by or [])
    values = restrict(df, row_condition).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return values.groupBy(*keys).agg(F.count(column).alias("_distinct"), F.sum("_n").alias("_rows"))


def expect_column_unique_value_count_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    tested = _uniqueness(df, column, group_by, row_condition).select(*(group_by or []), F.col("_distinct").alias("expression"))
    return failing(tested, bounds(F.col("expression"), min_value, max_value, strictly))


def expect_column_proportion_of_unique_values_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, group_by: GroupBy = None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    """Distinct values as a share of rows."""
    tested = _uniqueness(df, column, group_by, row_condition).select(
        *(group_by or []), F.try_divide("_distinct", "_rows").alias("expression")
    )
    return failing(tested, bounds(F.col("expression"), min_value, max_value, strictly))


def expect_column_values_to_be_within_n_stdevs(df: DataFrame, column: str, group_by: GroupBy = None, sigma_threshold: float = 3) -> DataFrame:
    """Group totals whose z-score against all groups' totals exceeds the threshold.

    The mean and deviation come from one-row scalar subqueries instead of a window over all
    groups in one task.
    """
    totals = df.groupBy(*(group_by or [])).agg(F.sum(column).alias(column))
    value = F.col(column).cast("double")
    mean = totals.select(F.avg(value)).scalar()
    deviation = totals.select(F.stddev_samp(value)).scalar()
    return totals.withColumns(
        {f"{column}_average": mean, f"{column}_stddev": deviation}
    ).withColumn(
        f"{column}_sigma", F.try_divide(value - F.col(f"{column}_average"), F.col(f"{column}_stddev"))
    ).filter(F.abs(f"{column}_sigma") > sigma_threshold)


def expect_column_values_to_be_within_n_moving_stdevs(
    df: DataFrame, column: str, date_column: str, as_of: Column, group_by: GroupBy = None, period: str = "day",
    lookback_periods: int = 1, trend_periods: int = 7, test_periods: int = 14, sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None, sigma_threshold_lower: float | None = None,
    take_diffs: bool = True, take_logs: bool = True,
) -> DataFrame:
    """Recent periods whose change lies too many deviations from the mean of the changes before it.

    A period's level is its group's sum, or the sum's logarithm (of nothing or zero: 0), and its change the level less the
    one ``lookback_periods`` rows earlier, if changes are wanted. The score compares a change with the
    ``trend_periods`` rows before; periods without a score pass. One row a group and period goes through the windows.
    """
    keys = list(group_by or [])
    limits = [-sigma_threshold if sigma_threshold_lower is None else sigma_threshold_lower, sigma_threshold if sigma_threshold_upper is None else sigma_threshold_upper]
    sums = df.groupBy(*keys, truncate(F.col(date_column), period).alias("period")).agg(F.sum(column).cast("double").alias("_sum"))
    level = F.coalesce(F.log(F.nullif("_sum", F.lit(0.0))) if take_logs else F.col("_sum"), F.lit(0.0))
    series = Window.partitionBy(*keys).orderBy("period")
    change = level - F.lag(level, lookback_periods, 0.0).over(series) if take_diffs else level
    before = series.rowsBetween(-trend_periods, -1)
    score = F.try_divide(F.col("change") - F.avg("change").over(before), F.stddev_samp("change").over(before))
    scored = sums.select(*keys, "period", change.alias("change")).withColumn("score", score)
    last = truncate(as_of, period)
    tested = scored.filter(F.col("period").between(add_periods(last, period, -test_periods), add_periods(last, period, -1)))
    return failing(tested, F.col("score").between(*limits))


def not_constant(df: DataFrame, column: str, group_by: GroupBy = None) -> DataFrame:
    """Groups where the column has a single value."""
    keys = list(group_by or [])
    spread = df.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"), F.count(column).alias("_n"))
    return spread.filter((F.col("_n") > 0) & (F.col("_lo") == F.col("_hi"))).select(*keys, F.lit(1).alias("n_distinct"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: GroupBy = None) -> DataFrame:
    share = F.try_divide(F.count(column), F.count(F.lit(1)))
    tested = df.groupBy(*(group_by or [])).agg(share.alias("not_null_proportion"))
    return tested.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def at_least_one(df: DataFrame, column: str, group_by: GroupBy = None) -> DataFrame:
    """Groups (or the table) without a single value; the ungrouped form stops at the first value."""
    keys = list(group_by or [])
    rows = df.select(*keys, column) if keys else df.filter(F.col(column).isNotNull()).select(column).limit(1)
    return rows.groupBy(*keys).agg(F.count(column).alias("n_values")).filter("n_values = 0")


def expect_multicolumn_sum_to_equal(df: DataFrame, columns: Sequence[str], sum_total, group_by: GroupBy = None, row_condition: Expr | None = None) -> DataFrame:
    """Groups where the column sums together miss a number or another column's sum."""
    total = sum((F.sum(c) for c in columns[1:]), F.sum(columns[0]))
    target = F.sum(sum_total) if isinstance(sum_total, str) else F.lit(sum_total)
    tested = restrict(df, row_condition).groupBy(*(group_by or [])).agg(total.alias("total"), target.alias("expected"))
    return failing(tested, F.col("total") == F.col("expected"))
