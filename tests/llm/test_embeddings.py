"""Embedding links against all pairs, in one block and in many."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.98):
    """{id: (n_links, component)} by comparing all pairs."""
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows
          if i is not None and k is not None and good(v)]
    links, root = [0] * len(ok), list(range(len(ok)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, v, k) in enumerate(ok):
        for j in range(i):
            _, w, m = ok[j]
            if k == m and len(v) == len(w):
                cos = math.fsum(a * b for a, b in zip(v, w)) / math.hypot(*v) / math.hypot(*w)
                if cos >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(ok):
        least[find(i)] = min(key, least.get(find(i), key))
    return sorted((key, links[i], least[find(i)], key == least[find(i)])
                  for i, (key, _, _) in enumerate(ok))


def vectors(n=150, dim=8, seed=1):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        v = [rng.gauss(0, 1) for _ in range(dim)]
        k = rng.choice((0, 0, 0, 1))
        for _ in range(rng.choice((1, 1, 2, 5))):
            rows.append((len(rows), [x + rng.gauss(0, rng.choice((0, 0.1))) for x in v], k))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell,block", [(1024, 1024), (20, 1024), (10, 7)])
def test_links_equal_all_pairs(spark, cell, block):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit(9)).withColumn("n", F.lit(9))
    got = E.near_duplicates(df, cell=cell, block=block).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_no_pair_is_lost_at_cell_borders():
    rng = np.random.default_rng(0)
    x = E.units(rng.normal(size=(400, 3)))  # three dimensions: many links over borders
    c = E.spherical_kmeans(x, 30)
    home, listed = E.cells(x, c, 0.98)
    for i, j in zip(*np.nonzero(x @ x.T >= 0.98)):
        assert listed[j, home[i]]
    assert listed.mean() < 0.5


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0),
            (6, [inf, 1.0], 0), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0),
            (10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0], 1), (12, [-1.0, 0.0], 0),
            (8, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (13, [1e-30, 0.0], 0), (14, [1.0, -0.0], 0)]
    got = {(r[0], *map(str, r[1:])) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, "0", str(i), "True") for i in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)} | {
        (8, "4", "8", "True"), (9, "4", "8", "False"), (13, "4", "8", "False"),
        (14, "4", "8", "False"), (None, "0", "None", "False")}


def test_empty_table_and_representatives(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert E.near_duplicates(df).count() == E.keep_representatives(df).count() == 0
    rows = vectors(40)
    kept = E.keep_representatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["vec_id"] for r in kept) == [k for k, _, _, keep in plain(rows) if keep]


def test_given_vectors(spark):
    from cumulus.llm.queries import op2_embedding_dedup
    sf = "/root/testdata/sf0.01"
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = {r["vec_id"]: r for r in op2_embedding_dedup(spark, sf).collect()}
    x, y = E.units(t["embedding"]), t["label"].to_numpy()
    close = (x @ x.T >= 0.98) & (y[:, None] == y[None, :])
    for i, links in zip(t["vec_id"], close.sum(axis=1) - 1):
        assert got[i]["n_links"] == links


def test_ids_are_whole_numbers(spark):
    df = spark.createDataFrame([("a", [1.0], 0)], "vec_id string, embedding array<float>, label int")
    with pytest.raises(TypeError, match="vec_id must be a whole number"):
        E.near_duplicates(df)
    small = df.withColumn("vec_id", F.lit(7).cast("int"))
    assert [tuple(r) for r in E.near_duplicates(small).collect()] == [(7, 0, 7, True)]


def test_cells_are_listed_on_one_side_only(spark):
    """A vector is its home's and later cells' alone, and most cells not at all."""
    rows = vectors(400, 16)
    df = spark.createDataFrame(rows, SCHEMA)
    groups = df.groupBy("label", F.col("embedding").alias("v")).agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("v"))
    listed = E._listed(groups, 0.98, 30).toPandas()
    home = listed[listed["home"]].set_index("rep")["cell"]
    assert len(home) == groups.count()
    assert (listed["cell"] >= listed["rep"].map(home)).all()
    assert sorted(map(tuple, E.near_duplicates(df, cell=30).collect())) == plain(rows)
