"""The general assertions the others are built from.

Every assertion returns the failing rows or groups; an empty result is a pass. A condition
that is null for a row does not fail it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Expr = str | Column

# Ways to leave out rows with missing values.
ALL_MISSING = "all_values_are_missing"
ANY_MISSING = "any_value_is_missing"


def as_column(expression: Expr) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def restrict(df: DataFrame, row_condition: Expr | None) -> DataFrame:
    return df if row_condition is None else df.filter(as_column(row_condition))


def failing(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false."""
    return df.filter(~condition)


def both(*conditions: Column | None) -> Column:
    given = [c for c in conditions if c is not None]
    result = given[0] if given else F.lit(True)
    for condition in given[1:]:
        result = result & condition
    return result


def bounds(value: Column, min_value=None, max_value=None, strictly: bool = False) -> Column:
    """Condition that a value lies within the given bounds."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    low = high = None
    if min_value is not None:
        low = value > F.lit(min_value) if strictly else value >= F.lit(min_value)
    if max_value is not None:
        high = value < F.lit(max_value) if strictly else value <= F.lit(max_value)
    return both(low, high)


def grouped_expression_is_true(
    df: DataFrame, expression: Expr, test_condition: str = "= true",
    group_by_columns: Sequence[str] | None = None, row_condition: Expr | None = None, aggregate: bool = False,
) -> DataFrame:
    """Rows, groups or the whole table whose expression does not meet the test condition."""
    rows = restrict(df, row_condition)
    value = as_column(expression).alias("expression")
    if group_by_columns:
        tested = rows.groupBy(*group_by_columns).agg(value)
    elif aggregate:
        tested = rows.agg(value)
    else:
        tested = rows.select("*", value)
    return tested.filter(f"not (expression {test_condition})")


def expression_between(
    df: DataFrame, expression: Expr, min_value=None, max_value=None, group_by_columns: Sequence[str] | None = None,
    row_condition: Expr | None = None, strictly: bool = False, aggregate: bool = True,
) -> DataFrame:
    """Groups (or the table, or rows) whose expression leaves the bounds."""
    rows = restrict(df, row_condition)
    value = as_column(expression).alias("expression")
    if aggregate:
        tested = rows.groupBy(*(group_by_columns or [])).agg(value)
    else:
        tested = rows.select("*", value)
    return failing(tested, bounds(F.col("expression"), min_value, max_value, strictly))


def one_row(*frames: DataFrame) -> DataFrame:
    """The columns of several one-row frames side by side, without a join."""
    stacked = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def equal_expression(
    df: DataFrame, expression: Expr, compare: DataFrame | None = None, compare_expression: Expr | None = None,
    group_by: Sequence[str] | None = None, compare_group_by: Sequence[str] | None = None,
    row_condition: Expr | None = None, compare_row_condition: Expr | None = None,
    tolerance: float = 0.0, tolerance_percent: float | None = None,
) -> DataFrame:
    """Groups whose aggregates differ between two tables by more than a tolerance.

    Both sides are aggregated before they meet.
    """
    left_by = list(group_by or [])
    right_by = list(compare_group_by or left_by)
    a = restrict(df, row_condition).groupBy(*left_by).agg(as_column(expression).alias("expression"))
    b = (
        restrict(df if compare is None else compare, row_condition if compare_row_condition is None else compare_row_condition)
        .groupBy(*right_by)
        .agg(as_column(expression if compare_expression is None else compare_expression).alias("compare_expression"))
    )
    if left_by:
        renamed = b.select(*[F.col(r).alias(n) for r, n in zip(right_by, left_by)], "compare_expression")
        paired = a.join(renamed, left_by, "full_outer")
    else:
        paired = one_row(a, b)
    gap = F.abs(F.coalesce("expression", F.lit(0)) - F.coalesce("compare_expression", F.lit(0)))
    compared = paired.withColumns(
        {
            "expression_difference": gap,
            "expression_difference_percent": F.try_divide(gap.cast("double"), F.col("expression").cast("double")),
        }
    )
    if tolerance_percent:
        return compared.filter(F.col("expression_difference_percent") > tolerance_percent)
    return compared.filter(F.col("expression_difference") > tolerance)


def keep_unless_missing(columns: Sequence[str], ignore_row_if: str = ALL_MISSING) -> Column:
    """Condition that keeps a row unless all (or any) of the columns are null."""
    if ignore_row_if not in (ALL_MISSING, ANY_MISSING):
        raise ValueError(f"ignore_row_if must be {ALL_MISSING!r} or {ANY_MISSING!r}")
    n_present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return n_present > 0 if ignore_row_if == ALL_MISSING else n_present == len(columns)
