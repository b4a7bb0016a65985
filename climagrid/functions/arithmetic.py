"""Null-tolerant arithmetic, rounding and bucketing as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius and miles-to-kilometres factor of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# Numeric type used where a value is compared as an exact decimal.
NUMERIC = "decimal(28,6)"


def to_column(value) -> Column:
    """Names become columns; Columns pass through; anything else is a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def round_half_away(value, digits: int = 0) -> Column:
    """Round a double half away from zero on the scaled value.

    Scaling first and comparing the fraction with one half keeps the work on JVM
    primitives and decides ties on the binary value. ``F.round`` goes through a
    decimal text per row, which is several times slower and decides ties such as
    ``-4999.985`` the other way.
    """
    x = to_column(value).cast("double")
    factor = float(10**digits)
    scaled = F.abs(x * factor)
    whole = F.floor(scaled)
    up = F.when(scaled - whole >= 0.5, 1).otherwise(0)
    # From 2**52 on a double has no fraction; NaN and infinities also end up here.
    return F.when(scaled < float(2**52), F.signum(x) * (whole + up) / factor).otherwise(x)


def safe_add(*fields) -> Column:
    """Sum with NULL counted as zero."""
    return reduce(lambda a, b: a + b, _zero_filled(fields))


def safe_subtract(*fields) -> Column:
    """Left-to-right difference with NULL counted as zero."""
    return reduce(lambda a, b: a - b, _zero_filled(fields))


def _zero_filled(fields) -> list[Column]:
    if not fields or any(isinstance(f, (list, tuple, dict)) for f in fields):
        raise ValueError("pass at least one column, each as its own argument")
    return [F.coalesce(to_column(f), F.lit(0)) for f in fields]


def safe_divide(numerator, denominator) -> Column:
    """Quotient, or NULL for a zero denominator."""
    return to_column(numerator) / F.nullif(to_column(denominator), F.lit(0))


def width_bucket(value, min_value, max_value, num_buckets) -> Column:
    """Bucket number 0 .. n+1 with exact bin multiples pushed to the next bucket.

    The tie test looks at the value itself, not its distance from the minimum, so
    a value above the maximum that is a multiple of the bin lands in n+2. A NULL
    value counts as above the maximum. Spark's own ``F.width_bucket`` is the standard
    variant without these two.
    """
    value, low, high, n = (to_column(c) for c in (value, min_value, max_value, num_buckets))
    bin_size = F.nullif(((high - low) / n).cast("double"), F.lit(0.0))
    exact_bin = F.nullif(bin_size.try_cast(NUMERIC), F.lit(0).cast(NUMERIC))
    tie = F.when(value.try_cast(NUMERIC) % exact_bin == 0, 1).otherwise(0)
    position = F.least(F.ceil((value - low) / bin_size), n + 1)
    return (tie + position).cast("long")


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (to_column(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin(F.radians((lat2 - lat1) / 2)), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), 2)
    miles = 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(half_chord))
    return miles * (KM_PER_MILE if unit == "km" else 1)
