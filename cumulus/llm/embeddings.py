"""Embedding near-duplicates: spherical k-means cells, cosine products in blocks.

Unit vectors belong to the cell of the nearest centroid.  Two vectors within
the threshold's angle may lie in different cells, so a vector is also listed in
every later cell whose border is no farther than that angle; every link is then
found once, in the later one of its ends' home cells, for both ends, and none is lost.
Centroids come from a bounded sample (SAMPLE vectors) and steer the work only.

Equal vectors of a label are one vector with a count from the start.  A cell is
compared in blocks of at most BLOCK homes and members a side, spread over
tasks; a block returns counts and no more links than it has members.

Defined results: vectors without a label, null, empty, zero, or with a null or
non-finite element link with nothing and are their own component; vectors of
different lengths do not link.  Rows without an id link with nothing, have no
component and are not kept.  Repeated rows are vectors of their own that link
with each other.  Ids are whole numbers; others raise.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from . import grid
from .common import stored
from .components import components

THRESHOLD = 0.98
SAMPLE = 8192     # vectors the centroids are fitted on, at most
ROUNDS = 10       # rounds of k-means
CELL = 512        # vectors of a label aimed at in a cell
MAX_CELLS = 2048  # centroids go to every task; beyond that the cells grow instead
BLOCK = 1024      # vectors a side of a block
SLACK = 1e-6      # on the border distance, for rounding


def units(vectors) -> np.ndarray:
    """Rows of length 1, in double precision."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """At most k unit centroids of the unit rows of x, by cosine."""
    rng = np.random.default_rng(seed)
    c = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        home = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.where(size > 1e-9, size, 1), c)
    return np.unique(c, axis=0)


def distances(c: np.ndarray) -> np.ndarray:
    """Between unit centroids; a little too large, which lists more, not less."""
    return np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T))) + 1e-7


def cells(x: np.ndarray, c: np.ndarray, threshold: float,
          between: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and which cells to list it in: those with a
    border no farther off than the threshold's angle."""
    s = x @ c.T
    home = np.argmax(s, axis=1)
    apart = (distances(c) if between is None else between)[home]
    reach = np.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else 1.0
    listed = s[np.arange(len(x)), home][:, None] - s <= (reach + SLACK) * apart
    listed[np.arange(len(x)), home] = True
    return home, listed


def _valid(vector: str):
    good = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e)
                    & (F.abs(e) != F.lit(float("inf"))))
    return F.coalesce(good & F.exists(vector, lambda e: e != 0), F.lit(False))


def _listed(groups: DataFrame, threshold: float, cell: int) -> DataFrame:
    """(rep, n, label, dim, cell, home, v): the groups, listed in their cells."""
    size = groups.agg(F.count(F.lit(1)).alias("n"),
                      F.approx_count_distinct("label").alias("labels")).first()
    k = min(MAX_CELLS, -(-size["n"] // (cell * max(1, size["labels"]))))
    centroids: dict[int, np.ndarray] = {}
    if k > 1:
        picked = groups.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("dim", "v").toPandas()
        for dim, part in picked.groupby("dim"):
            centroids[int(dim)] = spherical_kmeans(units(part["v"]), k)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between = {dim: distances(c) for dim, c in centroids.items()}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                c = centroids.get(int(dim))
                if c is None:  # a length that the sample has not: one cell
                    yield part.assign(cell=0, home=True)[COLUMNS]
                    continue
                home, listed = cells(units(part["v"]), c, threshold, between[int(dim)])
                # Cells before the home list nothing: those homes are listed here.
                listed &= np.arange(listed.shape[1]) >= home[:, None]
                i, j = np.nonzero(listed)
                yield part.iloc[i].assign(cell=j, home=home[i] == j)[COLUMNS]

    kind = groups.schema["label"].dataType.simpleString()
    vector = groups.schema["v"].dataType.simpleString()
    return groups.mapInPandas(assign, f"rep long, n long, label {kind}, dim int, v {vector}, "
                                      "cell int, home boolean")


COLUMNS = ["rep", "n", "label", "dim", "v", "cell", "home"]


def _compare(threshold: float):
    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        """a, b, links: links of each home with others, and of others with homes, and a
        forest of them.  Two homes meet in a pair of blocks, or twice in one."""
        role = pdf["role"].to_numpy()
        rows, cols = role != grid.COLUMN, role != grid.ROW
        if not rows.any() or not cols.any():
            return pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        x, rep, n = units(pdf["v"]), pdf["rep"].to_numpy(), pdf["n"].to_numpy()
        r, c = rep[rows], rep[cols]
        close = (x[rows] @ x[cols].T >= threshold) & (r[:, None] != c[None, :])
        a, b = grid.forest(close, r, c)
        links = np.concatenate([close @ n[cols], np.zeros(len(a) - len(r), np.int64)])
        guest = ~pdf["home"].to_numpy(bool)[cols]
        a, b = np.concatenate([a, c[guest]]), np.concatenate([b, c[guest]])
        links = np.concatenate([links, n[rows] @ close[:, guest]])
        keep = (a != b) | (links > 0)
        return pd.DataFrame({"a": a[keep], "b": b[keep], "links": links[keep]})
    return block


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", *, threshold: float = THRESHOLD, cell: int = CELL,
                    block: int = BLOCK) -> DataFrame:
    """key, n_links, component_id, kept: one row per row of ``df``; kept marks the
    representative of each component, its smallest key."""
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be a whole number, not {df.schema[key].dataType.simpleString()}")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"),
                     F.col(f"`{vector}`").alias("v"))
    comparable = F.col("id").isNotNull() & F.col("label").isNotNull() & _valid("v")
    groups = stored(rows.filter(comparable).groupBy("label", "v")
                    .agg(F.min("id").cast("long").alias("rep"), F.count(F.lit(1)).alias("n"))
                    .withColumn("dim", F.size("v")), "vectors")
    keys = ["label", "dim", "cell"]
    listed = stored(_listed(groups, threshold, cell), "listed")
    found = stored(grid.in_blocks(listed, keys, "rep", "home", block)
                   .groupBy(*keys, "rb", "cb")
                   .applyInPandas(_compare(threshold), "a long, b long, links long"), "links")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comps = components(found.select("a", "b")).select(F.col("node").alias("rep"),
                                                      F.col("label").alias("component"))
    named = stored(groups.select("label", "v", "rep", "n")
                   .join(counts, "rep", "left").join(comps, "rep", "left")
                   .select("label", "v",
                           (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component_id")), "named_vectors")
    linked = rows.filter(comparable).join(named, ["label", "v"]).select(
        "id", "n_links", "component_id")
    alone = rows.filter(~comparable).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(key), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_representatives(df: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """``df`` with the rows of kept keys only."""
    kept = near_duplicates(df, key, **options).filter("kept").select(
        F.col(key).alias("__k")).distinct()
    return df.join(kept, df[f"`{key}`"] == F.col("__k"), "left_semi")
