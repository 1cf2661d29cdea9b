"""Numeric column functions with the null / NaN rules the results depend on."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(value: float) -> Column:
    return F.lit(float(value))


def is_nan(c: Column) -> Column:
    return F.isnan(c.cast("double"))


def is_inf(c: Column) -> Column:
    return c.cast("double").isin(float("inf"), float("-inf"))


def present(c: Column) -> Column:
    """The value as a double, NULL for NaN: both mean missing, and NULL is the form kept."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; a missing value stays missing (``greatest`` alone would turn NULL into ``low``)."""
    value = present(c)
    return F.when(value.isNotNull(), F.least(dbl(high), F.greatest(dbl(low), value)))


def clamp01(c: Column) -> Column:
    return clip(c, 0.0, 1.0)


def round_up(c: Column, digits: int) -> Column:
    """Round a finite value half up on its binary form; a missing value stays missing."""
    scale = dbl(10.0**digits)
    return F.floor(present(c) * scale + dbl(0.5)).cast("double") / scale


def round_even(c: Column, digits: int = 0) -> Column:
    """Round half to even by scaling, the rule of vectorised numeric libraries."""
    scale = dbl(10.0 ** abs(digits))
    if digits == 0:
        return F.rint(c)
    if digits > 0:
        return F.rint(c * scale) / scale
    return F.rint(c / scale) * scale


def inf_to_null(c: Column) -> Column:
    c = c.cast("double")
    return F.when(is_nan(c) | is_inf(c), F.lit(None).cast("double")).otherwise(c)



def safe_float(c: Column, default: float = 0.0, allow_inf: bool = False) -> Column:
    """None, blank, NaN, unparseable (and, unless allowed, infinite) values become ``default``."""
    value = F.trim(c.cast("string")).try_cast("double")
    bad = value.isNull() | is_nan(value)
    if not allow_inf:
        bad = bad | is_inf(value)
    return F.when(bad, dbl(default)).otherwise(value)


def null_to_zero(c: Column) -> Column:
    c = c.cast("double")
    return F.when(c.isNull() | is_nan(c), dbl(0.0)).otherwise(c)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c.cast("double"), dbl(0.0))


def percent_to_unit(c: Column) -> Column:
    """0..100 (or 0..10000) to 0..1: values above 100 are divided by 100 first; no value gives 0."""
    v = c.cast("double")
    v = F.when(v > 100.0, v / dbl(100.0)).otherwise(v)
    return F.when(v.isNull() | is_nan(v), dbl(0.0)).otherwise(clamp01(v / dbl(100.0)))


def unit_if_above_one(c: Column) -> Column:
    """Finite values above 1 are percentages; NULL and non-finite values are missing."""
    v = inf_to_null(c)
    return F.when(v > 1.0, v / dbl(100.0)).otherwise(v)


def value_and_status(c: Column) -> Column:
    """Struct (value, status): ``missing`` for no text, ``invalid`` for no finite number; 0 is valid."""
    text = c.cast("string")
    value = inf_to_null(F.trim(text).try_cast("double"))
    status = (
        F.when(text.isNull() | (text == ""), "missing").when(value.isNull(), "invalid").otherwise("valid")
    )
    return F.struct(value.alias("value"), status.alias("status"))


def sigmoid(c: Column) -> Column:
    return dbl(1.0) / (dbl(1.0) + F.exp(-c))


def at_most_count(c: Column, thresholds: list[float], strict: bool = True) -> Column:
    """How many of the given constants lie below the value (one comparison each, in generated code)."""
    total = F.lit(0)
    for t in thresholds:
        total = total + F.when(c > dbl(t) if strict else c >= dbl(t), 1).otherwise(0)
    return total


def uniform(key: Column, draw: int, seed: int) -> Column:
    """Uniform draw in (0, 1) fixed by (key, draw, seed).

    The draw does not depend on partitioning, so a lost task that runs again on
    another executor makes the same numbers. Two draws share one digest.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{draw // 2}:{seed}")))
    part = F.substring(digest, 1 if draw % 2 == 0 else 14, 13)
    return (F.conv(part, 16, 10).cast("double") + dbl(0.5)) / dbl(16.0**13)


def normal(key: Column, draw: int, seed: int) -> Column:
    """Standard normal draw from two uniform draws."""
    u, v = uniform(key, 2 * draw, seed), uniform(key, 2 * draw + 1, seed)
    return F.sqrt(dbl(-2.0) * F.log(u)) * F.cos(dbl(2.0 * math.pi) * v)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Stable bucket of a key, the same on every run and partitioning."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
