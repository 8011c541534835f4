"""Filter interaction audit: what each filter removes in every order of filters.

A document fails some of the filters, which makes a mask.  Applied in an order, it
goes at the first filter of its mask.  The orders in which that is the filter at a
given step share a prefix of filters that the document passes and one that it
fails; numbered lexicographically (Lehmer rank), the orders with one prefix are
consecutive.  So each mask's removal step covers a few intervals of ranks: its
count is added where an interval begins and taken off where it ends, and a prefix
sum over the ranks gives what every order removes at every step.

Spark finds the masks from the texts and counts documents by part and mask, at most
2^filters rows a part; the difference arrays are worked on batches of parts.

The filters: A few words, B few distinct words, C many capital letters, D symbols,
E a copy of a text with a smaller key, wherever that is and whatever becomes of it.
E needs no group of copies in one place: the least key of each text's digest is an
aggregate, and it is joined on digest and key together, which no group shares.

Defined results: a null text counts as empty (no words; A fails, B, C and D do not),
and empty texts are copies of each other.  A null key is no smaller or greater than
any; its row is never a copy and makes none, and has no label.  Rows of the same key
are no copies of each other.  A key's labels count once: a flag is set if any of its
label rows sets it.  A null part counts as the empty string.  Repeated rows
count as often as they occur.  Texts are read whole; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, words

FILTERS = "ABCDE"
FEW_WORDS, DISTINCT, CAPITALS = 200, 50, 2   # words; percent of words; percent of characters
SYMBOLS = "[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text alone (A is bit 0)."""
    t = F.coalesce(text, F.lit(""))
    w = words(t)
    fails = (F.size(w) < FEW_WORDS,
             100 * F.size(F.array_distinct(w)) < DISTINCT * F.size(w),
             100 * F.regexp_count(t, F.lit("[A-Z]")).cast("long") > CAPITALS * F.length(t).cast("long"),
             t.rlike(SYMBOLS))
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id",
          text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of every document."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = stored(docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(""))
        .alias("part"), F.unhex(F.sha2(t, 256)).alias("digest"),
        text_failures(F.col(f"`{text}`")).cast("int").alias("mask")), "audit_rows")
    keyed, unkeyed = rows.filter("key IS NOT NULL"), rows.filter("key IS NULL")
    first = keyed.groupBy("digest").agg(F.min("key").alias("key"), F.lit(0).alias("copy"))
    out = keyed.join(first, ["digest", "key"], "left").withColumn(
        "mask", F.col("mask") + F.coalesce("copy", F.lit(1 << FILTERS.index("E"))))
    flags = {"good": F.lit(0), "toxic": F.lit(0)}
    if labels is not None:
        out = out.join(labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("key")).agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "key", "left")
        flags = {c: F.coalesce(c, F.lit(0)) for c in flags}
    cols = ["part", "mask"]
    return out.select(*cols, *[c.alias(n) for n, c in flags.items()]).unionByName(
        unkeyed.select(*cols, F.lit(0).alias("good"), F.lit(0).alias("toxic")))


def intervals(n: int = len(FILTERS)) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, end rank): in orders of these ranks a row of the mask
    goes at the step (from 0).  A prefix of ``step`` filters passed and one failed
    fixes (n - step - 1)! consecutive orders, beginning at the prefix's Lehmer rank."""
    for step in range(n):
        width = factorial(n - step - 1)
        for prefix in permutations(range(n), step + 1):
            left, rank = list(range(n)), 0
            for place, f in enumerate(prefix):
                rank += left.index(f) * factorial(n - place - 1)
                left.remove(f)
            *passed, failed = prefix
            for mask in range(1 << n):
                if mask >> failed & 1 and not any(mask >> f & 1 for f in passed):
                    yield mask, step, rank, rank + width


def removals(counts: np.ndarray, n: int = len(FILTERS)) -> np.ndarray:
    """Counts by row and mask → counts removed by row, rank of the order and step."""
    edges = np.zeros((len(counts), factorial(n) + 1, n), np.int64)
    for mask, step, begin, end in intervals(n):
        edges[:, begin, step] += counts[:, mask]
        edges[:, end, step] -= counts[:, mask]
    return np.cumsum(edges, axis=1)[:, :-1]


def audit(masked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows (part, mask, good, toxic)."""
    n, orders = len(filters), np.asarray(list(permutations(range(len(filters)))))
    names = ["".join(filters[f] for f in order) for order in orders]
    by_mask = masked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield table(batch.slice(at, 64))

    def table(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = batch.num_rows
        counts = np.zeros((3, p, 1 << n), np.int64)
        for i, found in enumerate(batch.column(1).to_pylist()):
            for f in found:
                counts[:, i, f["mask"]] = f["n"], f["good"], f["toxic"]
        removed, good, toxic = (removals(c, n) for c in counts)
        kept = counts[0].sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2)
        mask = np.arange(1 << n)
        fails = np.stack([counts[0][:, mask >> f & 1 == 1].sum(axis=1) for f in range(n)], axis=1)
        alone = counts[0][:, [1 << f for f in range(n)]]
        shapley = np.stack([removed[:, orders == f].sum(axis=1) for f in range(n)], axis=1)
        values = {"kept": kept, "removed": removed, "redundant": fails[:, orders] - removed,
                  "unique_fails": alone[:, orders], "good_lost": good, "toxic_lost": toxic,
                  "shapley": shapley[:, orders]}
        each = len(orders) * n
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(p), each))),
             pa.array(np.tile(np.repeat(names, n), p)),
             pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), p * len(orders))),
             *[pa.array(values[c].reshape(-1).astype(np.int64)) for c in COUNTS]],
            ["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(expand, "part string, filter_order string, step int, "
                            + ", ".join(f"{c} long" for c in COUNTS))
