"""Typed parsing, clamping and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_int(value: Column, default: int = 0) -> Column:
    """Whole number or `default`; fractions in text do not parse, float inputs truncate."""
    return F.coalesce(value.try_cast("bigint"), F.lit(default).cast("bigint"))


def to_float(value: Column, default: float | Column = 0.0) -> Column:
    """Double or `default`; NaN and infinities count as missing."""
    number = value.try_cast("double")
    fallback = default if isinstance(default, Column) else F.lit(float(default))
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return F.when(usable, number).otherwise(fallback)


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def half_up(value: Column, digits: int) -> Column:
    """Round half up with one multiply, floor and divide, so every engine gives the same double."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def to_units(value: Column, digits: int) -> Column:
    """A double as whole 10^-digits units. Sums of units do not depend on the order of rows."""
    return F.floor(value * F.lit(float(10**digits)) + F.lit(0.5))


def mean_of_units(total: Column, count: Column, unit_digits: int, digits: int) -> Column:
    """Mean of unit sums, rounded half up to `digits`, in whole-number arithmetic."""
    step = count * F.lit(10 ** (unit_digits - digits))
    rounded = F.call_function("div", total * F.lit(2) + step, step * F.lit(2))
    return rounded / F.lit(float(10**digits))


def first_truthy_number(*values: Column) -> Column:
    """First value that is neither missing nor zero, else 0: zero falls through to the next alias."""
    return F.coalesce(*[F.nullif(to_float(value), F.lit(0.0)) for value in values], F.lit(0.0))


def first_nonblank(*values: Column) -> Column:
    """First text that is neither missing nor empty."""
    return F.coalesce(*[F.nullif(value.cast("string"), F.lit("")) for value in values])
