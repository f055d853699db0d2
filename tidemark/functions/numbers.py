"""Null-safe arithmetic, buckets and distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Earth radius in miles and the kilometre factor that published results use.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _zeroed(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def safe_add(*columns: Column) -> Column:
    """Sum with nulls counted as zero."""
    total = _zeroed(columns[0])
    for column in columns[1:]:
        total = total + _zeroed(column)
    return total


def safe_subtract(first: Column, *rest: Column) -> Column:
    """First minus all others, nulls counted as zero."""
    total = _zeroed(first)
    for column in rest:
        total = total - _zeroed(column)
    return total


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Division that gives null where the denominator is zero or null."""
    return F.try_divide(numerator, denominator)


def width_bucket(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Equal-width bucket number; 0 below the range and ``buckets + 1`` at or above its end."""
    return F.width_bucket(value.cast("double"), low.cast("double"), high.cast("double"), F.lit(buckets))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError("unit must be 'mi' or 'km'")
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        half_lon
    ) * F.sin(half_lon)
    miles = F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2.0 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles
