"""The filter audit against applying every order of filters to every document."""

from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
from pyspark.sql import functions as F

from cumulus.llm import audit as A, queries
from tests.llm.test_pipeline import _split

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [(1, LONG, "s"), (2, LONG, "t"), (3, LONG, "s"), (3, LONG, "s"), (4, "few words", "s"), (5, "", None),
        (6, None, ""), (7, "same " * 300, "s"), (8, LONG.upper(), "t"), (9, LONG + " #1", "t"),
        (None, LONG, "s"), (None, None, None), (10, "\x0b \t", "t"), (11, LONG + " #1", "u"), (0, "few words", "u"),
        (12, "A" * 5 + " 100% " * 210, "u"), (12, "other text of a known key", "u")]
LABELS = [(1, 1, 0), (3, 1, 1), (3, 0, None), (9, 0, 1), (None, 1, 1), (12, None, 1), (99, 1, 1)]


def plain_mask(key, text, rows):
    t = text or ""
    w = [x for x in _split(t) if x]
    fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w),
             100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t),
             key is not None and any(k is not None and k < key and (x or "") == t for k, x, _ in rows))
    return "".join(f for f, bad in zip("ABCDE", fails) if bad)


def plain(rows, labels):
    docs = []
    for key, text, part in rows:
        own = [x for x in labels if key is not None and x[0] == key]
        docs.append((part or "", plain_mask(key, text, rows), any(x[1] == 1 for x in own),
                     any(x[2] == 1 for x in own)))
    out = []
    for part in {d[0] for d in docs}:
        mine, shapley, listed = [d for d in docs if d[0] == part], Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                listed.append((part, order, step, len(left), len(gone),
                               sum(f in d[1] for d in mine) - len(gone), sum(d[1] == f for d in mine),
                               sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in listed]
    return out


def test_audit_equals_applying_every_order(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumns(
        {"mask": F.lit("own"), "good": F.lit(3), "part": F.lit(1.5)}).repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn(
        "text", F.lit("own"))
    got = A.audit(A.masks(docs, labels))
    assert got.columns == ["part", "filter_order", "step", *A.COUNTS]
    assert sorted(map(tuple, got.collect())) == sorted(plain(ROWS, LABELS))
    alone = A.audit(A.masks(docs)).filter("good_lost + toxic_lost > 0")
    assert alone.count() == 0


def test_intervals_are_the_ranks_of_each_removal_step():
    orders = ["".join(p) for p in permutations("ABCDE")]
    covered = Counter()
    for mask, step, begin, end in A.intervals():
        for order in orders[begin:end]:
            first = next(i for i, f in enumerate(order) if mask >> "ABCDE".index(f) & 1)
            assert first == step
            covered[mask, order] += 1
    assert covered == Counter({(m, o): 1 for m in range(1, 32) for o in orders})


def test_removals_of_other_numbers_of_filters():
    counts = np.arange(16).reshape(2, 8)
    got = A.removals(counts, 3)
    for rank, order in enumerate(permutations(range(3))):
        for step, f in enumerate(order):
            here = [m for m in range(8) if m >> f & 1 and not any(m >> g & 1 for g in order[:step])]
            assert got[:, rank, step].tolist() == counts[:, here].sum(axis=1).tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert A.audit(A.masks(docs)).collect() == []


def test_many_parts(spark):
    docs = spark.range(150).select(F.col("id").alias("doc_id"), F.lit("short").alias("text"),
                                   F.col("id").cast("string").alias("source"))
    got = A.audit(A.masks(docs))
    assert got.count() == 150 * 600
    assert got.filter("filter_order = 'EABCD' AND step = 1").agg(F.sum("removed")).first()[0] == 149


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.TABLES_ORACLE["op13_filter_audit"])
    got = queries.op13_filter_audit(spark, SF)
    assert got.columns == [c[0] for c in cur.description]
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())
