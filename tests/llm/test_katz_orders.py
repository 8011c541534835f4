"""Katz backoff above pairs against a plain recursion over dictionaries."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulus.llm import katz as K, katz_orders as O

from .test_katz import corpus, split


class Plain:
    """P(w | h) for histories of any length up to order - 1, the start included."""

    def __init__(self, texts, order):
        lines = [["<s>", *split(t)] for t in texts]
        self.order = order
        self.words = Counter(w for t in lines for w in t[1:])
        self.total = sum(self.words.values())
        self.grams = {k: Counter(tuple(t[i:i + k]) for t in lines for i in range(len(t) - k + 1))
                      for k in range(2, order + 1)}
        self.d = {k: K.discounts([Counter(c.values())[r] for r in range(K.LARGEST + 2)])
                  for k, c in [(1, self.words), *self.grams.items()]}
        self.after = {}
        for k, c in self.grams.items():
            for g, n in c.items():
                self.after.setdefault(g[:-1], {})[g[-1]] = n
        held = sum(self.cut(1, n) for n in self.words.values())
        self.left = 1 - held / max(1, self.total)
        self.scale = 1
        if self.left <= 1e-12:
            self.scale, self.left = self.total / (self.total + 1), 1 / (self.total + 1)

    def cut(self, k, n):
        return n if n > K.LARGEST else self.d[k][n] * n

    def p(self, h, w):
        if not h:
            n = self.words[w]
            return self.scale * self.cut(1, n) / self.total if n else self.left
        seen = self.after.get(h)
        if not seen:
            return self.p(h[1:], w)
        k, n = len(h) + 1, sum(seen.values())
        held = sum(self.cut(k, x) for x in seen.values())
        if n - held < 1e-9 * n:
            n += 1
        if w in seen:
            return self.cut(k, seen[w]) / n
        weight = (1 - held / n) / (1 - math.fsum(self.p(h[1:], x) for x in seen))
        return weight * self.p(h[1:], w)

    def score(self, text):
        t = ["<s>", *split(text)]
        return sum(math.log10(self.p(tuple(t[max(0, i - self.order + 1):i]), t[i]))
                   for i in range(1, len(t)))


TEXTS = corpus(1, 120, 25) + ["a b c d e f g"] * 12 + ["a b c x", "", None]
ASKS = corpus(2, 40, 40) + ["a b c d e f g", "a b c x y", "b c d", "g f e", "", None,
                            "never seen before at all", "A B\tC d"]


@pytest.mark.parametrize("order", [3, 4])
@pytest.mark.parametrize("frequent", [1e-5, 0.02])
def test_scores_equal_plain_recursion(spark, order, frequent, monkeypatch):
    monkeypatch.setattr(K, "VOCABULARY", frequent)
    plain = Plain(TEXTS, order)
    model = O.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"), order=order)
    assert sorted(model.orders) == list(range(3, order + 1)) and model.total == plain.total
    df = spark.createDataFrame([*enumerate(ASKS), (0, ASKS[0]), (None, "a b c")],
                               "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("t1", F.lit(1))
    got = O.score(df, model, buckets=3).collect()
    assert len(got) == len(ASKS) + 2
    for r in got:
        text = "a b c" if r["doc_id"] is None else ASKS[r["doc_id"]]
        assert r["n_tokens"] == len(split(text))
        assert r["score"] == pytest.approx(plain.score(text), abs=1e-8), text


@pytest.mark.parametrize("order", [3, 4])
def test_probabilities_after_every_context_add_up_to_one(order):
    plain = Plain(TEXTS, order)
    for h in plain.after:
        if "</s>" not in h:
            total = math.fsum(plain.p(h, w) for w in plain.words) + plain.p(h, "another one")
            assert total == pytest.approx(1, abs=1e-9)


def test_tables_add_up_to_one(spark):
    """Of the tables themselves: what the seen grams of a context hold, and its weight
    times what the order below leaves for the others."""
    model = O.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"), order=3)
    order = model.orders[3]
    rows = (order.grams.join(order.contexts, ["t1", "t2"])
            .select("t1", "t2", "weight", F.pow(F.lit(10.0), "log_p").alias("p"),
                    F.pow(F.lit(10.0), F.col("log_p") - F.col("gain") - F.col("weight")).alias("low"))
            .groupBy("t1", "t2", "weight").agg(F.sum("p").alias("p"), F.sum("low").alias("low")).collect())
    assert len(rows) == order.contexts.count() > 100
    for r in rows:
        assert r["p"] + 10 ** r["weight"] * (1 - r["low"]) == pytest.approx(1, abs=1e-9)


def test_order_two_is_the_pairs(spark):
    train = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    df = spark.createDataFrame(list(enumerate(ASKS)), "doc_id long, text string")
    a = O.score(df, O.train(train, order=2)).orderBy("doc_id").collect()
    assert a == K.score(df, K.train(train)).orderBy("doc_id").collect()
    with pytest.raises(ValueError, match="order must be 2 or more"):
        O.train(train, order=1)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    texts = [" ".join(t for t in TEXTS if t)] * 2
    plain = Plain(texts, 3)
    monkeypatch.setattr(O, "SLICE", 7)
    model = O.train(spark.createDataFrame([(t,) for t in texts], "text string"), order=3)
    got = O.score(spark.createDataFrame([(1, texts[0])], "doc_id long, text string"), model).first()
    assert got["score"] == pytest.approx(plain.score(texts[0]), abs=1e-7)


def test_nothing_to_learn_from_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = O.score(df, O.train(none)).orderBy("doc_id").collect()
    assert list(map(tuple, got)) == [(None, 1, 0, 0.0, 0.0), (1, 3, 0, 0.0, 0.0)]
    assert O.score(none, O.train(df)).count() == 0
    assert O.score(df, O.train(df)).count() == 2
