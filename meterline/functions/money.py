"""Exact money rounding.

``round_half_even_ratio(num, den)`` returns round-half-even(num / den) for
integer-valued decimal columns, using only integer arithmetic (truncating
quotient, remainder, comparison), so the result is the exact rational
rounding in any engine -- no dependence on the scale of an intermediate
division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT38 = "decimal(38,0)"


def cents(c: Column) -> Column:
    """decimal(12,2) amount -> integer cents as decimal(38,0)."""
    return (c * 100).cast(INT38)


def _quotient(a: Column, b: Column) -> Column:
    """floor(a / b) for non-negative integer decimals, exact: (a - a mod b) is a multiple of b."""
    return ((a - F.pmod(a, b)).cast(INT38) / b).cast(INT38)


def round_half_even_ratio(num: Column, den: Column) -> Column:
    n, d = num.cast(INT38), den.cast(INT38)
    a, b = F.abs(n), F.abs(d)
    q = _quotient(a, b)
    r = (a - q * b).cast(INT38)
    twice = (r * 2).cast(INT38)
    up = (twice > b) | ((twice == b) & (F.pmod(q, F.lit(2)) == 1))
    mag = F.when(up, q + 1).otherwise(q).cast(INT38)
    neg = (n < 0) != (d < 0)
    return F.when(neg, -mag).otherwise(mag).cast(INT38)


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(38,2)") / 100).cast("decimal(12,2)")


def round_half_up_ratio(num: Column, den: Column) -> Column:
    """Exact round-half-away-from-zero(num / den) on integer-valued decimals (SQL ROUND semantics)."""
    n, d = num.cast(INT38), den.cast(INT38)
    a, b = F.abs(n), F.abs(d)
    q = _quotient(a, b)
    r = (a - q * b).cast(INT38)
    mag = F.when((r * 2).cast(INT38) >= b, q + 1).otherwise(q).cast(INT38)
    neg = (n < 0) != (d < 0)
    return F.when(neg, -mag).otherwise(mag).cast(INT38)
