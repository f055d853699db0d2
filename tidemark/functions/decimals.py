"""Exact decoding of base64 big-endian two's-complement integers into decimals.

Everything stays inside generated code. Values of up to eight bytes go through one signed base
conversion; wider ones are sign-extended to 128 bits as hex text, read as four 32-bit limbs and
recombined in decimal arithmetic. Intermediate values are projected step by step so that each
is computed once per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

_LIMB = 4294967296  # 2 ** 32
_NARROW_DIGITS = 16
_WIDE_DIGITS = 32


@dataclass(frozen=True)
class Encoded:
    """One decimal to decode: source text, target name and type, fixed or per-row scale."""

    target: str
    source: Column
    precision: int
    scale: int
    row_scale: Column | None = None


def _narrow(digits: Column, negative: Column) -> Column:
    filled = F.when(negative, F.lpad(digits, _NARROW_DIGITS, "F")).otherwise(F.lpad(digits, _NARROW_DIGITS, "0"))
    return F.conv(filled, 16, -10).cast("bigint").cast("decimal(38,0)")


def _wide(digits: Column, negative: Column) -> Column:
    filled = F.when(negative, F.lpad(digits, _WIDE_DIGITS, "F")).otherwise(F.lpad(digits, _WIDE_DIGITS, "0"))
    base = F.lit(_LIMB).cast("decimal(10,0)")
    limbs = [F.conv(F.substring(filled, i * 8 + 1, 8), 16, 10).cast("decimal(10,0)") for i in range(4)]
    value = (limbs[0] - F.when(negative, base).otherwise(F.lit(0).cast("decimal(10,0)"))).cast("decimal(38,0)")
    for limb in limbs[1:]:
        value = (value * base + limb).cast("decimal(38,0)")
    return value


def _text_shift(unscaled: Column, scale: Column) -> Column:
    """Decimal text of ``unscaled / 10**scale`` without any division."""
    magnitude = F.abs(unscaled).cast("string")
    padded = F.when(F.length(magnitude) > scale, magnitude).otherwise(F.lpad(magnitude, scale + F.lit(1), F.lit("0")))
    whole = F.substring(padded, F.lit(1), F.length(padded) - scale)
    fraction = F.substring(padded, F.length(padded) - scale + 1, scale)
    return F.concat(F.when(unscaled < 0, "-").otherwise(""), whole, F.lit("."), fraction)


def _scaled(item: Encoded) -> Column:
    unscaled = F.col(f"_int_{item.target}")
    if item.row_scale is None and item.scale <= 6:
        shifted = unscaled * F.lit(Decimal(1).scaleb(-item.scale)) if item.scale else unscaled
    else:
        shifted = _text_shift(unscaled, F.lit(item.scale) if item.row_scale is None else F.col(f"_scale_{item.target}"))
    return shifted.try_cast(f"decimal({item.precision},{item.scale})")


def with_decimals(df: DataFrame, items: Sequence[Encoded]) -> DataFrame:
    """Add one decimal column per item; unreadable or too wide values give null."""
    if not items:
        return df
    kept = df.columns
    hexed = df.withColumns({
        **{f"_hex_{i.target}": F.hex(F.try_to_binary(i.source, F.lit("base64"))) for i in items},
        **{f"_scale_{i.target}": i.row_scale for i in items if i.row_scale is not None},
    })

    def integer(name: str) -> Column:
        digits = F.col(f"_hex_{name}")
        negative = F.substring(digits, 1, 1) >= F.lit("8")
        size = F.length(digits)
        return F.when((size > 0) & (size <= _NARROW_DIGITS), _narrow(digits, negative)).when(
            (size > _NARROW_DIGITS) & (size <= _WIDE_DIGITS), _wide(digits, negative)
        )

    numbered = hexed.withColumns({f"_int_{i.target}": integer(i.target) for i in items})
    return numbered.select(*kept, *[_scaled(i).alias(i.target) for i in items])


def encode_integer(value: Column) -> Column:
    """Base64 of the big-endian two's-complement bytes of a bigint (the inverse, for feeds)."""
    digits = F.hex(value.cast("bigint"))
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    top_set = (F.substring(even, 1, 1) >= F.lit("8")) & (value >= 0)
    return F.base64(F.unhex(F.when(top_set, F.concat(F.lit("00"), even)).otherwise(even)))
