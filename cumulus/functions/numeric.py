"""Rounding, rates and weighted sums (ANSI-safe: no division can raise)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

from ._util import as_col

# Digits-rounding goes through an exact decimal so that half-way cases are
# decided on the decimal value, not on the binary double.
_EXACT = DecimalType(38, 12)


def round_half_even(c, digits: int = 0) -> Column:
    """Round half to even.  Whole numbers on doubles; digits via decimal."""
    c = as_col(c)
    if digits == 0:
        return F.bround(c)
    return F.bround(c.try_cast(_EXACT), digits).cast("double")


def safe_div(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(as_col(num).cast("double"), as_col(den))


def per_capita(num, pop, scale: float = 100000) -> Column:
    """(num / pop) * scale, in that order of operations."""
    return safe_div(num, pop) * F.lit(scale)


def weighted_sum(terms) -> Column:
    """Σ col / divisor over ``[(col, divisor), ...]`` (divisor 1 = as is).

    Two-dose products count half per delivered dose: ``[(m, 2), (p, 2), (j, 1)]``.
    """
    out = None
    for c, div in terms:
        part = as_col(c) / F.lit(float(div)) if div != 1 else as_col(c)
        out = part if out is None else out + part
    return out
