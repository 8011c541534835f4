"""Dimension joins and scalar lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A dimension is broadcast only when it is proven to hold at most this many
# rows and bytes (measured together in one bounded job); beyond either, the
# join stays a shuffle join (AQE may still switch it to a broadcast from the
# measured size at run time).
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def rows_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has ≤ n rows.  One bounded action: each task stops
    after n+1 rows, so the cost does not grow with the table."""
    return df.limit(n + 1).count() <= n


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 per field plus the bytes of variable-length values
    (text, binary; nested values by their JSON text)."""
    parts = [F.lit(8 * len(df.columns))]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
    return reduce(lambda a, b: a + b, parts)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has ≤ max_rows rows holding ≤ max_bytes in all.  One
    bounded action: at most max_rows + 1 rows are read and summed."""
    r = (df.limit(max_rows + 1)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))
           .first())
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def join_dim(df: DataFrame, dim: DataFrame, left_on, right_on, how: str = "inner",
             max_broadcast_rows: int = BROADCAST_MAX_ROWS,
             null_safe: bool = False,
             max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Many-to-one equi-join of facts to a dimension whose key has another name.

    With ``how="inner"`` the join doubles as a filter: fact rows whose key is
    not in the dimension are dropped.
    """
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = [right_on] if isinstance(right_on, str) else list(right_on)
    small = fits_broadcast(dim, max_broadcast_rows, max_broadcast_bytes)
    side = F.broadcast(dim) if small else dim
    conds = [(df[l].eqNullSafe(side[r]) if null_safe else df[l] == side[r])
             for l, r in zip(left_on, right_on)]
    return df.join(side, reduce(lambda a, b: a & b, conds), how)


def scalar_value(df: DataFrame, key_col: str, key_value, value) -> Column:
    """Value of ``value`` on the row where key_col == key_value, as a scalar
    subquery usable inside row expressions.  Evaluating it raises unless
    exactly one row matches, as a missing row must not turn into a NULL."""
    v = F.col(value) if isinstance(value, str) else value
    one = df.filter(F.col(key_col) == F.lit(key_value)).agg(
        F.count(F.lit(1)).alias("n"), F.max(v).alias("v"))
    wrong = F.raise_error(F.format_string(f"{key_col} = {key_value}: %d rows, not one", F.col("n")))
    return one.select(F.when(F.col("n") == 1, F.col("v")).otherwise(
        wrong.cast(one.schema["v"].dataType))).scalar()
