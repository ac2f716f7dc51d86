"""Scalar helpers: lenient casts, ages, growth, clamps, hashed uniforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lenient_double(c) -> Column:
    """Bad text -> NULL (ANSI mode stays on; ``try_cast`` never throws)."""
    return _c(c).try_cast("double")


def lenient_int(c) -> Column:
    return lenient_double(c).try_cast("int")


def age_in_years(age, unit, age_max: float = 120.0) -> Column:
    """A = years, M = months, D = days, any other unit kept as is; then ages
    outside [0, age_max] become NULL."""
    num = lenient_double(age)
    u = F.upper(F.trim(_c(unit)))
    years = F.when(u == "M", num / 12.0).when(u == "D", num / 365.0).otherwise(num)
    return F.when((years < 0) | (years > age_max), F.lit(None).cast("double")).otherwise(years)


def growth(cur, lag1) -> Column:
    """(x - lag1) / (lag1 + 1); counts are >= 0 so the denominator is >= 1."""
    return (_c(cur) - _c(lag1)) / (_c(lag1) + 1.0)


def clamp(c, lo, hi) -> Column:
    return F.greatest(F.least(_c(c), F.lit(hi)), F.lit(lo))


def hash_uniform(*parts, seed: int = 42) -> Column:
    """Uniform in (0, 1) from the md5 of the row identity and a seed.

    Independent of partitioning and evaluation order, and reproducible in any
    SQL engine with md5 + hex parsing (first 8 hex digits / 2^32, nudged off 0)."""
    key = F.concat_ws("|", *[_c(p).cast("string") for p in parts], F.lit(str(seed)))
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return (h + 0.5) / F.lit(4294967296.0)
