"""Katz backoff of any order above pairs, on top of the pairs of ``katz``.

Each order k has two tables: the k-grams seen in training, with their Good-Turing
discounted probability and what that has over backing off; and the contexts of k - 1
tokens, with the backoff weight that makes the probabilities after them add up to
exactly one.  A token is scored by the recursion

    P_k(w | h) = d(c) c(h w) / c(h)          where h w was seen,
                 weight(h) P_k-1(w | h')     where only h was seen,
                 P_k-1(w | h')               else,

h' being h without its first token.  In log10 a text's score is therefore that by pairs
plus, order by order, the weights of its seen contexts and the gains of its seen grams:
two joins with sums an order, none of which needs the other orders.

Grams are built of the words' numbers (from 1; 0 is the start), so they are exact.  A
gram reaches back to the start at most.  Tasks count their own grams before anything is
shuffled, and joins are between written tables, which Spark can split at a gram or a
context that very many texts share.

Defined results are those of ``katz``; order 2 is ``katz`` itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from . import katz
from .common import drop, stored

SLICE = 500_000  # grams made, and counted, together


@dataclass
class Order:
    grams: DataFrame     # t1 .. tk, log_p, gain: log10 of P, and of P over backing off
    contexts: DataFrame  # t1 .. t(k-1), weight: log10 of the backoff weight


@dataclass
class Model:
    pairs: katz.Model
    orders: dict[int, Order] = field(default_factory=dict)  # from 3 on

    @property
    def total(self) -> int:
        return self.pairs.total


def _names(k: int) -> list[str]:
    return [f"t{i}" for i in range(1, k + 1)]


def _added(parts: list[np.ndarray], columns: list[str]) -> pd.DataFrame:
    """The different rows of the parts, and how often each stands there."""
    x = np.concatenate(parts)
    x = x[np.lexsort(x.T[::-1])]
    new = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1))))
    return pd.DataFrame(x[new], columns=columns).assign(n=np.diff(np.append(new, len(x))))


def _grams(ids: DataFrame, k: int, by_row: bool) -> DataFrame:
    """(row, t1 .. tk, n): grams and their counts, by text or together, as far as a
    slice of a task's texts goes."""
    columns, most = ["row"] * by_row + _names(k), SLICE

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait, size = [], 0
        for pdf in batches:
            for row, blob in zip(pdf["row"], pdf["ids"]):
                line = np.concatenate(([0], katz._flat(blob) + 1))
                for at in range(0, len(line) - k + 1, most):
                    part = np.lib.stride_tricks.sliding_window_view(line[at:at + most + k - 1], k)
                    if by_row:
                        part = np.column_stack((np.full(len(part), row), part))
                    wait.append(part)
                    size += len(part)
                    if size >= most:
                        yield _added(wait, columns)
                        wait, size = [], 0
        if wait:
            yield _added(wait, columns)

    rows = ids.select(F.col("row") if by_row else F.lit(0).cast("long").alias("row"), "ids")
    return rows.mapInPandas(cut, ", ".join(f"{c} long" for c in [*columns, "n"]))


def _pair_rows(model: katz.Model) -> DataFrame:
    """(t1, t2, log_p) of all pairs, from their tables by bucket."""
    numbers = model.numbers

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = katz._table(pdf["blob"][pdf["role"] == katz.TABLE])
        owners, *halves = katz._table(pdf["blob"][pdf["role"] == katz.WEIGHTS], 4)
        first, second = numbers.split(keys)
        common = first < numbers.firsts
        held = np.ones(len(keys))
        held[common] = numbers.held[first[common]]
        at = np.searchsorted(owners, first[~common].astype(np.uint64))
        held[~common] = katz._whole(*halves[:2], float)[at]
        log_p = np.log10(katz._factor(numbers.pair_d, n) * n) - np.log10(held)
        return pd.DataFrame({"t1": first, "t2": second + 1, "log_p": log_p})

    tables = [t.select("bucket", F.lit(role).alias("role"), "blob")
              for role, t in ((katz.TABLE, model.pairs), (katz.WEIGHTS, model.weights))]
    return tables[0].union(tables[1]).groupBy("bucket").applyInPandas(
        rows, "t1 long, t2 long, log_p double")


def _factor(d: np.ndarray, n: Column) -> Column:
    given = F.array(*[F.lit(float(x)) for x in d[1:]])
    return F.when(n > katz.LARGEST, F.lit(1.0)).otherwise(F.try_element_at(given, n.cast("int")))


def _order(ids: DataFrame, low: DataFrame, k: int) -> Order:
    """The tables of order k from the texts' numbers and (t1 .. t(k-1), log_p) below."""
    spark, names, context = ids.sparkSession, _names(k), _names(k - 1)
    counted = stored(_grams(ids, k, False).groupBy(*names).agg(F.sum("n").alias("n")), f"grams_{k}")
    seen = {r["n"]: r["types"] for r in counted.filter(F.col("n") <= katz.LARGEST + 1)
            .groupBy("n").agg(F.count(F.lit(1)).alias("types")).collect()}
    d = katz.discounts([seen.get(r, 0) for r in range(katz.LARGEST + 2)])
    # A gram's end is a gram of the order below, which was counted at the same places.
    ends = low.select(*[F.col(c).alias(names[i + 1]) for i, c in enumerate(context)],
                      F.col("log_p").alias("log_low"))
    rows = stored(counted.join(ends, names[1:])
                  .select(*names, "n", (_factor(d, F.col("n")) * F.col("n")).alias("held"), "log_low"),
                  f"backed_{k}")
    sums = rows.groupBy(*context).agg(F.sum("n").alias("n"), F.sum("held").alias("held"),
                                      F.sum(F.pow(F.lit(10.0), "log_low")).alias("p"))
    # No mass left over, as no count was small: one more event makes room for it.
    n = F.when(F.col("n") - F.col("held") < 1e-9 * F.col("n"), F.col("n") + 1).otherwise(F.col("n"))
    left = (1 - F.col("held") / n) / F.greatest(1 - F.col("p"), F.lit(1e-300))
    contexts = stored(sums.select(*context, n.cast("double").alias("all"),
                                  F.log10(left).alias("weight")), f"contexts_{k}")
    log_p = F.log10("held") - F.log10("all")
    grams = stored(rows.join(contexts, context).select(
        *names, log_p.alias("log_p"), (log_p - F.col("log_low") - F.col("weight")).alias("gain")),
        f"weighted_{k}")
    drop(spark, counted, rows)
    return Order(grams, contexts.select(*context, "weight"))


def train(df: DataFrame, text: str = "text", *, order: int = 3) -> Model:
    """Counts, discounts and backoff weights of all orders up to ``order``, at least 2,
    from all texts of ``df``."""
    if order < 2:
        raise ValueError(f"order must be 2 or more, not {order}")
    model = Model(katz.train(df, text, keep_numbers=order > 2))
    if order > 2:
        low = pairs = stored(_pair_rows(model.pairs), "pair_rows")
        for k in range(3, order + 1):
            model.orders[k] = _order(model.pairs.training, low, k)
            low = model.orders[k].grams
        drop(df.sparkSession, model.pairs.training, pairs)
        model.pairs.training = None
    return model


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", *,
          buckets: int | None = None) -> DataFrame:
    """key, n_tokens, n_known, base_score, score as of ``katz.score``, the score by the
    highest order: one row per row of ``df``."""
    if not model.orders:
        return katz.score(df, model.pairs, key, text, buckets=buckets)
    # Written with the numbers, a row's own number stays what it is.
    ids = stored(katz.numbered(df, model.pairs, key, text)
                 .withColumn("row", F.monotonically_increasing_id()), "numbers")
    low = katz.score_numbers(ids.select(F.col("row").cast("string").alias("key"), "n_tokens", "ids"),
                             model.pairs, buckets)
    low = low.select(F.col("key").cast("long").alias("row"), "n_tokens", "n_known", "base_score", "score")
    parts = []
    for k, order in model.orders.items():
        parts.append(_grams(ids, k, True).join(order.grams, _names(k))
                     .select("row", (F.col("n") * F.col("gain")).alias("more")))
        # A context at the very end of a text is followed by nothing, and no gram's.
        parts.append(_grams(ids, k, True).join(order.contexts, _names(k - 1))
                     .select("row", (F.col("n") * F.col("weight")).alias("more")))
    more = parts[0]
    for part in parts[1:]:
        more = more.union(part)
    more = more.groupBy("row").agg(F.sum("more").alias("more"))
    return (ids.select("row", "key").join(low, "row").join(more, "row", "left")
            .select(F.col("key").cast(df.schema[key].dataType).alias(key), "n_tokens", "n_known",
                    "base_score", (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score")))
