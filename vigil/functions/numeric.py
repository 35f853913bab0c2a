"""Numeric helpers shared by operators and query outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, nd: int = 6) -> Column:
    """round(x * 10^nd) half away from zero, / 10^nd, all in double arithmetic.

    Spark's ``round`` rounds the shortest decimal form of a double, while C's
    ``round(x * 10^nd)`` sees the binary product; for values such as 0.0640625
    the two disagree.  Output columns that are compared across engines use
    this form, which is the binary one.  ``rint`` is half-to-even, so exact
    ties are moved away from zero by hand; no cast to an integer type, so
    huge values and infinities pass through.
    """
    m = float(10 ** nd)
    y = x * m
    r = F.rint(y)
    return F.when(F.abs(y - r) == 0.5, y + F.signum(y) * 0.5).otherwise(r) / m


def round_sig(x: Column, digits: int = 10) -> Column:
    """Rounds to ``digits`` significant digits (float sums of large values
    differ between engines in the last bits only)."""
    nd = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    m = F.pow(F.lit(10.0), nd)
    y = x * m
    r = F.rint(y)
    out = F.when(F.abs(y - r) == 0.5, y + F.signum(y) * 0.5).otherwise(r) / m
    return F.when((x == 0) | x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(out)


def round_rint(x: Column, nd: int) -> Column:
    """rint(x * 10^nd) / 10^nd: one reference to ``x`` (no duplicated input
    expression), half-to-even only on exact binary ties of the product."""
    m = float(10 ** nd)
    return F.rint(x * m) / m


def canonical(x: Column, nd: int = 6, pre: int = 9) -> Column:
    """Comparable output form of a float: rounded to ``pre`` decimals, then to
    ``nd`` decimals, and -0.0 folded into 0.0.  Two engines whose results
    differ only in the last bits (summation order) land on the same value,
    also when the exact result sits on a half at the (nd+1)-th decimal.
    Plain double arithmetic (no log / pow), so it stays cheap per value."""
    return round_half_away(round_rint(x, pre), nd) + F.lit(0.0)
