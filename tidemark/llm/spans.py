"""Places of pattern matches in texts as column expressions, in time that grows with the text and its matches.

Spark copies what an aggregate over an array holds for every item, so arrays aren't gathered in such a state: running sums
are made chunk by chunk instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Items of a chunk; each item of a chunk is worked out from those before it.
CHUNK = 128
FOUND = "struct<start:int,end:int,match:string>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each item of an array, ``join`` over it and all before it."""
    def part(a: Column, c: Column) -> Column:
        return F.slice(a, c * CHUNK + 1, F.lit(CHUNK))

    def total(a: Column, n: Column) -> Column:
        return F.aggregate(F.slice(a, F.lit(1), n), zero, join)

    def of_chunks(a: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int"))
        totals = F.transform(numbers, lambda c: F.aggregate(part(a, c), zero, join))
        before = bound(totals, lambda t: F.transform(t, lambda _, c: total(t, c)))
        return F.flatten(F.transform(before, lambda b, c: bound(
            part(a, c), lambda p: F.transform(p, lambda _, i: join(b, total(p, i + 1))))))

    return bound(values, lambda a: F.when(F.size(a) > 0, of_chunks(a)).otherwise(a))


def found(text: Column, pattern: str, gate: Column) -> Column:
    """Matches of a pattern as an array of (start, end, match), in code points; none where the gate is false."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    pieces = F.struct(gaps.alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["matches"])), x["matches"], lambda g, m: g + F.char_length(m))
        return F.zip_with(running(steps, F.lit(0), lambda a, b: a + b), x["matches"], lambda end, m: F.struct(
            (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("match")))

    return F.when(gate, bound(pieces, placed)).otherwise(F.array().cast(f"array<{FOUND}>"))


#: Code points of a piece of a text.
PIECE = 1024


def pieces(text: Column) -> Column:
    """The text in pieces, so that a place far inside needn't be counted from the text's start."""
    last = F.floor((F.greatest(F.char_length(text), F.lit(1)) - 1) / PIECE).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(text, k * PIECE + 1, F.lit(PIECE)))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of the text whose pieces are given."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor(F.greatest(end - 1, start) / PIECE).cast("int")
    held = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * PIECE + 1, end - start)).otherwise(F.lit(""))
