"""Reshaping helpers over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import add_periods, boundaries_between


def pivot(
    df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, agg: str = "sum",
    then_value: Column | None = None, else_value: Column | None = None, cmp: str = "=",
    prefix: str = "", suffix: str = "", distinct: bool = False,
) -> DataFrame:
    """Values to columns by conditional aggregates: one pass, no discovery job.

    ``cmp`` compares the column with each value; ``else_value=None`` leaves non-matches null.
    """
    tests = {
        "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    }
    then = F.lit(1) if then_value is None else then_value
    other = F.lit(0) if else_value is None else else_value

    def cell(value) -> Column:
        picked = F.when(tests[cmp](F.col(column), F.lit(value)), then).otherwise(other)
        if distinct:
            return F.count_distinct(picked) if agg == "count" else F.sum_distinct(picked)
        return getattr(F, agg)(picked)

    return df.groupBy(*group_by).agg(*[cell(v).alias(f"{prefix}{v}{suffix}") for v in values])


def unpivot(
    df: DataFrame, exclude: Sequence[str] = (), remove: Sequence[str] = (), cast_to: str = "string",
    field_name: str = "field_name", value_name: str = "value",
) -> DataFrame:
    """Columns to rows; excluded columns are kept on every row, removed ones dropped."""
    skip = {c.lower() for c in (*exclude, *remove)}
    columns = [c for c in df.columns if c.lower() not in skip]
    shaped = df.select(*exclude, *[F.col(c).cast(cast_to).alias(c) for c in columns])
    return shaped.unpivot(list(exclude), columns, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame], include: Sequence[str] | None = None, exclude: Sequence[str] = (),
    column_override: Mapping[str, str] | None = None, source_column: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union tables with different columns, each row labelled with the table it came from."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    overrides = {k.lower(): v for k, v in (column_override or {}).items()}
    parts = []
    for label, df in relations.items():
        names = [
            c for c in df.columns
            if (not include or c.lower() in {i.lower() for i in include})
            and c.lower() not in {e.lower() for e in exclude}
        ]
        rows = df.filter(where) if where else df
        part = rows.select(*[
            (F.col(c).cast(overrides[c.lower()]) if c.lower() in overrides else F.col(c)).alias(c) for c in names
        ])
        parts.append(part.withColumn(source_column, F.lit(label)) if source_column else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def star(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "", rename: Mapping[str, str] | None = None) -> list[Column]:
    """All columns but the excepted ones, optionally renamed, prefixed or suffixed."""
    skip = {c.lower() for c in except_}
    names = rename or {}
    return [
        F.col(c).alias(f"{prefix}{names.get(c, c)}{suffix}") for c in df.columns if c.lower() not in skip
    ]


def date_spine(bounds: DataFrame, period: str, start: str, end: str, name: str | None = None, inclusive: bool = False) -> DataFrame:
    """Every period from each row's start up to its end, for one row of bounds or many.

    The end is left out unless ``inclusive``. Periods are counted first, then expanded, so month
    steps keep the day of the start instead of drifting.
    """
    first, last = F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz")
    label = name or f"date_{period}"
    steps = boundaries_between(first, last, period)
    rows = bounds.filter(first.isNotNull() & last.isNotNull() & (first <= last)).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), steps)).alias("_step")
    )
    value = add_periods(first, period, F.col("_step").cast("int"))
    keep = (value <= last) if inclusive else (value < last)
    return rows.withColumn(label, value).filter(keep).drop("_step")


def generate_series(spark: SparkSession, upper: int, name: str = "generated_number") -> DataFrame:
    """Integers from 1 to ``upper``, generated on the executors."""
    return spark.range(1, upper + 1).select(F.col("id").alias(name))


def column_values(df: DataFrame, column: str, where: str | Column | None = None, max_records: int | None = None) -> DataFrame:
    """Distinct values by descending frequency."""
    rows = df.filter(where) if where is not None else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(
        F.col("n_rows").desc(), "value"
    )
    return counted.limit(max_records) if max_records else counted


def nullcheck(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Blank strings to null in every string column."""
    return df.select(*[
        nullcheck(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
        for f in df.schema.fields
    ])
