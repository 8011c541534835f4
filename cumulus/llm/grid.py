"""Comparing all members of a group in blocks spread over tasks.

A group has homes, which are compared with all its members, and others, which
are not compared among themselves.  A small group is one block; a larger one
is a grid of blocks, each with at most about ``block`` homes and as many
members, so a group of any size neither lands in one task nor is turned into
all its pairs by a join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import fits_broadcast
from .common import stored

HOME, COLUMN, ROW = 1, 2, 3  # roles in a block: both, compared with, compared


def in_blocks(rows: DataFrame, keys: list[str], member: str, home: str, block: int) -> DataFrame:
    """``rows`` with role, rb and cb added; (keys, rb, cb) names a block.

    A group of up to ``block`` rows is one block, its rows HOME or COLUMN.  In a
    larger one each home goes as ROW to every block of its stripe of rows, and
    each member as COLUMN to every block of its stripe of columns.
    """
    big = (rows.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(home).cast("long")).alias("m"))
           .filter((F.col("n") > block) & (F.col("m") > 0)))
    big = stored(big.select(*keys, F.ceil(F.col("n") / block).alias("nc"),
                            F.ceil(F.col("m") / block).alias("nr")), "large_groups")
    x = rows.join(F.broadcast(big) if fits_broadcast(big) else big, keys, "left")
    h = F.xxhash64(member)
    rb, cb = F.pmod(h, F.col("nr")), F.pmod(h, F.col("nc"))
    zero = F.lit(0).cast("long")
    as_row = F.transform(F.sequence(zero, F.col("nc") - 1), lambda c: F.struct(
        F.lit(ROW).alias("role"), rb.alias("rb"), c.alias("cb")))
    as_col = F.transform(F.sequence(zero, F.col("nr") - 1), lambda r: F.struct(
        F.lit(COLUMN).alias("role"), r.alias("rb"), cb.alias("cb")))
    alone = F.array(F.struct(F.when(F.col(home), HOME).otherwise(COLUMN).alias("role"),
                             zero.alias("rb"), zero.alias("cb")))
    places = F.when(F.col("nc").isNull(), alone).otherwise(
        F.when(F.col(home), F.concat(as_row, as_col)).otherwise(as_col))
    return x.select(*[f"`{c}`" for c in rows.columns], F.explode(places).alias("__place")).select(
        *[f"`{c}`" for c in rows.columns], "__place.*")


def forest(close: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as all close (row, column) pairs, one for
    each member at most; a member may be linked with itself."""
    none = len(rows)
    label_r, label_c = np.arange(none), np.full(len(cols), none)
    while True:
        for_c = np.where(close, label_r[:, None], none).min(axis=0, initial=none)
        label_c = np.minimum(label_c, for_c)
        for_r = np.where(close, label_c[None, :], none).min(axis=1, initial=none)
        new = np.minimum(label_r, for_r)
        if (new == label_r).all():
            break
        label_r = new
    linked = label_c < none
    return (np.concatenate([rows, cols[linked]]),
            np.concatenate([rows[label_r], rows[label_c[linked]]]))
