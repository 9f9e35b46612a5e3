"""Exact time arithmetic: rational timebases to microseconds and back to text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def divide_half_even(num: Column, den: Column) -> Column:
    """num / den for whole numbers, den > 0, rounded half to even without passing through doubles."""
    n, d = num.cast("decimal(38,0)"), den.cast("decimal(38,0)")
    r = F.pmod(n, d)
    q = ((n - r) / d).cast("decimal(38,0)")
    up = (r * 2 > d) | ((r * 2 == d) & (F.pmod(q, F.lit(2).cast("decimal(38,0)")) == 1))
    return (q + F.when(up, 1).otherwise(0)).cast("long")


def pts_to_microseconds(pts: Column, base_num: Column, base_den: Column) -> Column:
    """pts * num / den seconds in microseconds."""
    return divide_half_even(pts.cast("decimal(19,0)") * base_num.cast("decimal(10,0)") * F.lit(1_000_000).cast("decimal(7,0)"), base_den)


def microseconds_to_seconds(us: Column) -> Column:
    """Seconds as text, with at least three decimals and no trailing zeros beyond them."""
    a = F.abs(us)
    frac = F.lpad((a % 1_000_000).cast("string"), 6, "0")
    tail = F.regexp_replace(F.substring(frac, 4, 3), "0+$", "")
    return F.concat(F.when(us < 0, "-").otherwise(""), F.floor(a / F.lit(1_000_000).cast("decimal(7,0)")).cast("string"), F.lit("."), F.substring(frac, 1, 3), tail)


def round_half_away(x: Column) -> Column:
    """To the nearest whole number, halves away from zero."""
    return F.signum(x) * F.floor(F.abs(x) + 0.5)
