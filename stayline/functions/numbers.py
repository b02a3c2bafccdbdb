"""Numeric helpers with one rounding rule and NULL for undefined ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double half away from zero, on the binary value.

    The built-in ``round`` goes through decimals and differs on values such as 0.285.
    """
    scale = F.lit(float(10**digits))
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


# A sum of doubles changes in its last bits with the order in which tasks add, which flips a
# mean that lies on a rounding tie. Each value becomes two integers here, a whole part and a
# 30-bit rest, whose sums are exact in any order. ``unit`` scales before the cut: 2**30 keeps
# 60 bits of values in [0, 1], 1 keeps 2**-30 of any value. NULLs are skipped.
_REST = float(2**30)
UNIT = float(2**30)


def exact_parts(x: Column, name: str, unit: float = 1.0, weight: Column | None = None) -> list[Column]:
    """Aggregates ``<name>_hi``, ``<name>_lo`` and ``<name>_n``, to be summed again or read by the functions below."""
    scaled = x.cast("double") * unit
    high = F.floor(scaled)
    low = F.floor((scaled - high) * _REST + 0.5)
    if weight is None:
        return [F.sum(high).alias(f"{name}_hi"), F.sum(low).alias(f"{name}_lo"), F.count(x).alias(f"{name}_n")]
    counted = F.when(x.isNotNull(), weight)
    return [F.sum(high * weight).alias(f"{name}_hi"), F.sum(low * weight).alias(f"{name}_lo"), F.sum(counted).alias(f"{name}_n")]


def part_names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in ("hi", "lo", "n")]


def summed_parts(name: str) -> list[Column]:
    """Sums of the parts of partial aggregates."""
    return [F.sum(part).alias(part) for part in part_names(name)]


def exact_total(name: str | Column, unit: float = 1.0) -> Column:
    part = name.getField if isinstance(name, Column) else None
    high, low = (part("x_hi"), part("x_lo")) if part else (F.col(f"{name}_hi"), F.col(f"{name}_lo"))
    return high / F.lit(unit) + low / F.lit(unit * _REST)


def exact_mean(name: str | Column, unit: float = 1.0) -> Column:
    """Mean from the columns of ``name``, or from a struct of the parts of ``x``."""
    count = name.getField("x_n") if isinstance(name, Column) else F.col(f"{name}_n")
    return F.try_divide(exact_total(name, unit), count.cast("double"))


def unit_mean(x: Column) -> Column:
    """Mean of values in [0, 1], as one aggregate."""
    return exact_mean(F.struct(*exact_parts(x, "x", UNIT)), UNIT)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """100 * num / den, rounded; NULL when den is 0."""
    return round_half_away(F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double")), digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def total_plays(counters: list[str]) -> Column:
    total = F.col(counters[0])
    for c in counters[1:]:
        total = total + F.col(c)
    return total
