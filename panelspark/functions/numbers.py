"""Cleaning of numeric text and null-safe arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from ..fixed_values import EARTH_RADIUS_MILES, KM_PER_MILE


def to_double(text: Column) -> Column:
    """Number or NULL; commas are not accepted."""
    return text.try_cast("double")


def clean_numeric(text: Column, target: str = "int") -> Column:
    """Drop thousands commas, then cast; whole-number targets round half away from zero.

    Text of whole numbers is cast directly, since a double holds no more than 53 bits.
    """
    plain = F.replace(text, F.lit(","), F.lit(""))
    number = plain.try_cast("double")
    if target in ("int", "integer", "bigint", "long", "smallint"):
        return F.coalesce(plain.try_cast(target), F.round(number).try_cast(target))
    return number.try_cast(target)


def clean_age(text: Column) -> Column:
    """``24-340`` and ``24`` both give 24."""
    return F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int")


def rate_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0 where the denominator is 0 or NULL."""
    empty = denominator.isNull() | (denominator == 0)
    return F.when(empty, F.lit(0.0)).otherwise(F.try_divide(numerator, denominator).cast("double"))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, or NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def _zero_for_null(columns: Sequence[Column], operator: str) -> list[Column]:
    if isinstance(columns, (str, Column)) or not columns:
        raise TypeError(f"{operator} takes a list of columns")
    return [F.coalesce(c, F.lit(0)) for c in columns]


def safe_add(columns: Sequence[Column]) -> Column:
    """Sum with NULL counted as 0."""
    return reduce(lambda a, b: a + b, _zero_for_null(columns, "safe_add"))


def safe_subtract(columns: Sequence[Column]) -> Column:
    """First minus all the others, NULL counted as 0."""
    return reduce(lambda a, b: a - b, _zero_for_null(columns, "safe_subtract"))


def width_bucket(value: Column, low, high, buckets) -> Column:
    """Bucket 1..n of an equal-width histogram; 0 below the range and n+1 from its end on."""
    return F.width_bucket(value, F.lit(low), F.lit(high), F.lit(buckets))


def width_bucket_compat(value: Column, low: float, high: float, buckets: int) -> Column:
    """Bucket formula without a lower guard: values below the range go to 0, -1, -2, ..."""
    width = (high - low) / buckets
    on_edge = (value.try_cast("decimal(28,6)") % F.lit(width).cast("decimal(28,6)")) == 0
    position = F.ceil((value - F.lit(low)) / F.lit(width))
    return F.when(on_edge, 1).otherwise(0) + F.least(position, F.lit(buckets + 1))


def haversine_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    scale = 1.0 if unit == "mi" else KM_PER_MILE
    half_lat = F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2)
    half_lon = F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2)
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon
    return F.lit(2.0 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord)) * F.lit(scale)
