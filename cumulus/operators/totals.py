"""Row binding by name and total rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class SchemaMismatch(TypeError):
    """Two inputs carry the same column with different types."""


def check_same_types(a: DataFrame, b: DataFrame) -> None:
    """Raise when a column present in both inputs has two types.

    Spark would silently coerce (a date ∪ a string becomes a date and fails
    on the first bad value at run time); the check is driver-side metadata.
    """
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    bad = {c: (ta[c], tb[c]) for c in ta.keys() & tb.keys() if ta[c] != tb[c]}
    if bad:
        raise SchemaMismatch(f"Can't combine columns with different types: {bad}")


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bind rows by column name; columns missing on one side become NULL."""
    check_same_types(a, b)
    return a.unionByName(b, allowMissingColumns=True)


def total_row(detail: DataFrame, label_col: str, label: str, sums=(), extra=None) -> DataFrame:
    """One-row table: ``label`` plus Σ of each column in ``sums`` (NULLs
    skipped) plus any ``extra`` {name: Column} (scalar subqueries welcome).
    The sums are a global aggregate: partial sums per task, one tiny merge."""
    aggs = [F.sum(c).alias(c) for c in sums]
    base = detail.agg(*aggs) if aggs else detail.sparkSession.range(1).select()
    cols = [F.lit(label).alias(label_col)] + [F.col(c) for c in sums]
    cols += [v.alias(k) for k, v in (extra or {}).items()]
    return base.select(*cols)


def with_total_row(total: DataFrame, detail: DataFrame, group_col: str | None = None) -> DataFrame:
    """Total row(s) placed above detail rows.  ``group_col`` (0 = total,
    1 = detail) is added when the caller needs to sort the result."""
    if group_col:
        total = total.withColumn(group_col, F.lit(0))
        detail = detail.withColumn(group_col, F.lit(1))
    return union_by_name(total, detail)
