"""Filter predicates with the tracked program's NULL semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col


def not_in_keep_null(c, values) -> Column:
    """NOT IN that keeps NULL keys (membership of NULL is false, not unknown)."""
    return ~F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def is_in(c, values) -> Column:
    return as_col(c).isin(list(values))


def nonzero(c) -> Column:
    """x != 0; drops 0 and NULL alike."""
    return as_col(c) != 0


def ne_and_not_null(c, value, other=None) -> Column:
    """c != value AND other IS NOT NULL (other defaults to c)."""
    other = as_col(c) if other is None else as_col(other)
    return (as_col(c) != value) & other.isNotNull()
