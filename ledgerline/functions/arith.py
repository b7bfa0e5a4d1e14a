"""Null-aware arithmetic on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Two-digit decimal: sums stay exact whatever order the partitions arrive in."""
    return col(c).cast("decimal(18,2)")


def div0(num: Column | str, den: Column | str) -> Column:
    """0 when the divisor is 0, NULL when either side is NULL."""
    n, d = col(num), col(den)
    return F.when((d == 0) & n.isNotNull(), F.lit(0.0)).otherwise(F.try_divide(n, d).cast("double"))


def div_null(num: Column | str, den: Column | str) -> Column:
    """NULL when the divisor is 0."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0))).cast("double")


def safe_add(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def strict_least(*cols: Column | str) -> Column:
    """``least`` that is NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cols]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.least(*cs))


def strict_greatest(*cols: Column | str) -> Column:
    cs = [col(c) for c in cols]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.greatest(*cs))


def band(c: Column | str, bounds: list[tuple[float, object]], above: object, missing: object = None) -> Column:
    """Label of the first upper bound (exclusive) that ``c`` stays under."""
    value = col(c)
    out = F.when(value.isNull(), F.lit(missing))
    for bound, label in bounds:
        out = out.when(value < bound, F.lit(label))
    return out.otherwise(F.lit(above))


def convert_bytes(c: Column | str, unit: str) -> Column:
    power = {"kb": 1, "mb": 2, "gb": 3}[unit]
    return (col(c) / F.lit(1024**power)).cast("decimal(16,2)")


def stable_bucket(c: Column | str, n: int) -> Column:
    """Deterministic stand-in for a random filler value in ``[0, n)``."""
    return F.pmod(F.xxhash64(col(c)), F.lit(n)).cast("int")


def half_up(c: Column | str, digits: int = 0) -> Column:
    """Half-up rounding by plain double arithmetic, the same on every engine."""
    scale = float(10**digits)
    x = col(c).cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5).cast("double") / scale
