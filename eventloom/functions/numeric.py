"""Numbers with a defined rounding, and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Half up on the double itself: floor(x * 10^digits + 0.5) / 10^digits; the same in every engine."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5).cast("double") / scale


def money(x: Column) -> Column:
    """Exact sums of amounts: decimal(18, 2)."""
    return x.cast("decimal(18,2)")


def lenient_double(x: Column) -> Column:
    """A number from text with thousands separators; null for blanks, NaN and anything else."""
    d = F.regexp_replace(F.trim(x), ",", "").try_cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


def lenient_int(x: Column, default: int | None = 0) -> Column:
    """A whole number by way of a double, cut towards zero."""
    return F.coalesce(lenient_double(x).try_cast("int"), F.lit(default))


def tri_state(x: Column) -> Column:
    """True, false or null from the usual words."""
    v = F.lower(F.trim(x))
    return F.when(v.isin("1", "true", "t", "yes", "y", "是"), True).when(v.isin("0", "false", "f", "no", "n", "否"), False)


def clamped(x: Column, low: float, high: float, default: float) -> Column:
    """Between two bounds, with a default for null."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(x, F.lit(default))))
