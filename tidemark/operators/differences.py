"""Comparing tables that mostly agree: digests of buckets first, rows only of buckets whose digests differ.

A bucket's digest is its row count, the exact sum of its rows' hashes and the exclusive or of a second hash; none of them depends on
order, and all are combined map-side, so a level of the comparison shuffles at most ``BUCKETS`` rows a task and side. Two
levels give ``BUCKETS`` squared leaves. Unequal buckets of equal digests would need two independent 64-bit hashes to agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.assertions.tables import equality
from tidemark.operators.quality import reconcile

BUCKETS = 2048
LEVELS = 2


def _bucket(by: Sequence[str], level: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by], F.lit(level)), F.lit(BUCKETS)).cast("int")


def _digests(df: DataFrame, buckets: Sequence[str], columns: Sequence[str], side: str) -> DataFrame:
    row = [F.col(f"`{c}`") for c in columns]
    first, second = F.xxhash64(*row), F.xxhash64(F.lit("second"), *row)
    return df.groupBy(*buckets).agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.sum(first.cast("decimal(20,0)")).alias("sum"), F.bit_xor(second).alias("xor")).alias(side))


def differing(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Both tables' rows in buckets that differ; rows are dealt by ``by`` and compared in ``columns``, of equal types on both sides.

    Each level reads both tables once more, less what earlier levels settled. The first level's differing buckets, at most
    ``BUCKETS`` numbers, are broadcast, so rows of buckets that agree there are never shuffled.
    """
    columns = list(columns or left.columns)
    names, sides = [], [left, right]
    for level in range(levels):
        names.append(f"_b{level}")
        sides = [s.withColumn(names[-1], _bucket(by, level)) for s in sides]
        a, b = (_digests(s, names, columns, side) for s, side in zip(sides, ("_a", "_b"), strict=True))
        odd = a.join(b, names, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*names)
        if level == 0:
            odd = F.broadcast(odd)
        sides = [s.join(odd, names, "left_semi") for s in sides]
    return sides[0].drop(*names), sides[1].drop(*names)


def equality_by_digest(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None, exclude_columns: Sequence[str] = ()) -> DataFrame:
    """``equality`` of the rows in buckets that differ; rows of equal buckets are read but never shuffled.

    Differing numbers of copies of a row make its bucket differ, but not the result.
    """
    names = [c for c in (compare_columns or df.columns) if c not in set(exclude_columns)]
    a, b = differing(df.select(*names), compare.select(*names), names)
    return equality(a, b, names)


def reconcile_by_digest(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.01) -> DataFrame:
    """``reconcile`` of the keys in buckets that differ; both tables hold one row a key, and the measure has one type."""
    kind = left.schema[measure].dataType
    narrow = lambda df: df.select(*keys, F.col(measure).cast(kind).alias(measure))
    a, b = differing(narrow(left), narrow(right), keys, [*keys, measure])
    return reconcile(a, b, keys, measure, tolerance)
