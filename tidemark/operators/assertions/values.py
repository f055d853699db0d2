"""Assertions on single rows: values, strings and column pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.assertions.core import (
    ALL_MISSING, Expr, bounds, failing, keep_unless_missing, restrict,
)


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return failing(df, bounds(F.col(column), min_value, max_value, strictly=not inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which ``<column> <expression>`` is false."""
    return failing(df, F.expr(f"{column} {expression}" if column else expression))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.filter(text == "")


def expect_column_values_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return failing(restrict(df, row_condition), bounds(F.col(column), min_value, max_value, strictly))


def expect_column_values_to_be_in_set(df: DataFrame, column: str, value_set: Sequence, row_condition: Expr | None = None) -> DataFrame:
    """Each value outside the set, once, with its row count."""
    rows = restrict(df, row_condition)
    return rows.filter(~F.col(column).isin(*value_set)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def expect_column_values_to_not_be_in_set(df: DataFrame, column: str, value_set: Sequence, row_condition: Expr | None = None) -> DataFrame:
    """Each forbidden value that occurs, once, with its row count."""
    rows = restrict(df, row_condition)
    return rows.filter(F.col(column).isin(*value_set)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def expect_column_values_to_be_null(df: DataFrame, column: str, row_condition: Expr | None = None) -> DataFrame:
    return restrict(df, row_condition).filter(F.col(column).isNotNull())


def expect_column_values_to_not_be_null(df: DataFrame, column: str, row_condition: Expr | None = None) -> DataFrame:
    return restrict(df, row_condition).filter(F.col(column).isNull())


def expect_column_pair_values_a_to_be_greater_than_b(df: DataFrame, column_a: str, column_b: str, or_equal: bool = False, row_condition: Expr | None = None) -> DataFrame:
    a, b = F.col(column_a), F.col(column_b)
    return failing(restrict(df, row_condition), a >= b if or_equal else a > b)


def expect_column_pair_values_to_be_equal(df: DataFrame, column_a: str, column_b: str, row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), F.col(column_a) == F.col(column_b))


def expect_column_pair_values_to_be_in_set(df: DataFrame, column_a: str, column_b: str, value_pairs_set: Sequence[tuple], row_condition: Expr | None = None) -> DataFrame:
    if any(len(pair) != 2 for pair in value_pairs_set):
        raise ValueError("value_pairs_set takes pairs")
    allowed = reduce(lambda x, y: x | y, [
        (F.col(column_a) == F.lit(a)) & (F.col(column_b) == F.lit(b)) for a, b in value_pairs_set
    ])
    return failing(restrict(df, row_condition), allowed)


def expect_select_column_values_to_be_unique_within_record(df: DataFrame, columns: Sequence[str], ignore_row_if: str = ALL_MISSING, row_condition: Expr | None = None) -> DataFrame:
    """Rows whose listed columns do not all differ; decided inside the row, no sort or shuffle."""
    rows = restrict(df, row_condition).filter(keep_unless_missing(columns, ignore_row_if))
    distinct = F.size(F.array_distinct(F.array_compact(F.array(*[F.col(c).cast("string") for c in columns]))))
    return rows.withColumn("n_distinct", distinct).filter(F.col("n_distinct") < len(columns))


def expect_column_value_lengths_to_be_between(df: DataFrame, column: str, min_value=None, max_value=None, row_condition: Expr | None = None, strictly: bool = False) -> DataFrame:
    return failing(restrict(df, row_condition), bounds(F.length(column), min_value, max_value, strictly))


def expect_column_value_lengths_to_equal(df: DataFrame, column: str, value: int, row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), F.length(column) == value)


def _matches(tests: Sequence[Column], match_on: str) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be 'any' or 'all'")
    return reduce((lambda x, y: x | y) if match_on == "any" else (lambda x, y: x & y), tests)


def expect_column_values_to_match_like_pattern(df: DataFrame, column: str, like_pattern: str, row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), F.col(column).like(like_pattern))


def expect_column_values_to_not_match_like_pattern(df: DataFrame, column: str, like_pattern: str, row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), ~F.col(column).like(like_pattern))


def expect_column_values_to_match_like_pattern_list(df: DataFrame, column: str, like_pattern_list: Sequence[str], match_on: str = "any", row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), _matches([F.col(column).like(p) for p in like_pattern_list], match_on))


def expect_column_values_to_not_match_like_pattern_list(df: DataFrame, column: str, like_pattern_list: Sequence[str], match_on: str = "any", row_condition: Expr | None = None) -> DataFrame:
    return failing(restrict(df, row_condition), _matches([~F.col(column).like(p) for p in like_pattern_list], match_on))


def _regex(column: str, pattern: str, flags: str) -> Column:
    """Whether the pattern is found anywhere, an empty match included; flags as inline letters."""
    return F.col(column).rlike(f"(?{flags}){pattern}" if flags else pattern)


def expect_column_values_to_match_regex(df: DataFrame, column: str, regex: str, row_condition: Expr | None = None, flags: str = "") -> DataFrame:
    return failing(restrict(df, row_condition), _regex(column, regex, flags))


def expect_column_values_to_not_match_regex(df: DataFrame, column: str, regex: str, row_condition: Expr | None = None, flags: str = "") -> DataFrame:
    return failing(restrict(df, row_condition), ~_regex(column, regex, flags))


def expect_column_values_to_match_regex_list(df: DataFrame, column: str, regex_list: Sequence[str], match_on: str = "any", row_condition: Expr | None = None, flags: str = "") -> DataFrame:
    return failing(restrict(df, row_condition), _matches([_regex(column, r, flags) for r in regex_list], match_on))


def expect_column_values_to_not_match_regex_list(df: DataFrame, column: str, regex_list: Sequence[str], match_on: str = "any", row_condition: Expr | None = None, flags: str = "") -> DataFrame:
    return failing(restrict(df, row_condition), _matches([~_regex(column, r, flags) for r in regex_list], match_on))

