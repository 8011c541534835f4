"""Katz backoff against a plain version over dictionaries; exact normalisation."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulus.llm import katz as K


def split(text):
    out = [""]
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w] + ["</s>"]


class Plain:
    def __init__(self, texts, vocabulary):
        tokens = [split(t) for t in texts]
        self.c = Counter(w for t in tokens for w in t)
        self.n = sum(self.c.values())
        self.vocab = {w for w, n in self.c.items() if n >= max(1, vocabulary * self.n)} | {"</s>"} & set(self.c)
        self.pairs = Counter(p for t in tokens for p in zip(["<s>", *map(self.cls, t)], map(self.cls, t)))
        self.d1, self.d2 = (K.discounts([Counter(c.values())[r] for r in range(K.LARGEST + 2)])
                            for c in (self.c, self.pairs))
        self.left = 1 - sum(self.d(self.d1, n) * n for n in self.c.values()) / max(1, self.n)
        self.scale = 1
        if self.left <= 1e-12:
            self.scale, self.left = self.n / (self.n + 1), 1 / (self.n + 1)
        self.rare = 1 - sum(self.word(w) for w in self.vocab)

    def d(self, d, n):
        return 1.0 if n > K.LARGEST else d[n]

    def cls(self, w):
        return w if w in self.vocab else "<rare>"

    def word(self, w):
        n = self.c[w]
        return self.scale * self.d(self.d1, n) * n / self.n if n else self.left

    def low(self, w):
        return self.word(w) if w in self.vocab else self.rare

    def after(self, h, w):
        """P(class w | class h)"""
        seen = {b: n for (a, b), n in self.pairs.items() if a == h}
        if not seen:
            return self.low(w)
        total, held = sum(seen.values()), sum(self.d(self.d2, n) * n for n in seen.values())
        every = len(seen) == len(self.vocab) + 1
        if total - held < 1e-9 * total:
            total += 1
        if w in seen:
            return self.d(self.d2, seen[w]) * seen[w] / (held if every else total)
        return (1 - held / total) / (1 - sum(map(self.low, seen))) * self.low(w)

    def p(self, h, w):
        p = self.after(self.cls(h) if h != "<s>" else h, self.cls(w))
        return p if w in self.vocab else p * self.word(w) / self.rare

    def score(self, text):
        ws = split(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *ws], ws))

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (self.n + len(self.c) + 1)) for w in split(text))


def corpus(seed, n=60, words=80):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocab, weights, k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("vocabulary", [1e-5, 0.01, 0.2])
def test_scores_equal_plain_version(spark, vocabulary, monkeypatch):
    texts, asks = corpus(1), corpus(2, 30, 120) + ["", None, "W1 w1\tw1 W1", "never seen ÄÖ äö"]
    plain = Plain(texts, vocabulary)
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    model = K.train(train, vocabulary=vocabulary)
    df = spark.createDataFrame(list(enumerate(asks)) + [(0, asks[0]), (None, "w1 w2")],
                               "doc_id long, text string").withColumn("key", F.lit(1))
    got = K.score(df, model, buckets=5, vocabulary=vocabulary).collect()
    assert len(got) == len(asks) + 2
    for r in got:
        text = "w1 w2" if r["doc_id"] is None else asks[r["doc_id"]]
        ws = split(text)
        assert (r["n_tokens"], r["n_known"]) == (len(ws), sum(plain.c[w] > 0 for w in ws))
        assert r["base_score"] == pytest.approx(plain.base(text), abs=1e-9)
        assert r["score"] == pytest.approx(plain.score(text), abs=1e-9)


@pytest.mark.parametrize("frequent", [1e-5, 0.02])
def test_rare_words_have_pairs_of_their_own(spark, frequent, monkeypatch):
    monkeypatch.setattr(K, "VOCABULARY", frequent)
    texts = corpus(1) * 300 + ["zeta omega", "w1 zeta omega w1", "w7 w70 alone"]
    asks = ["zeta omega", "omega zeta", "w1 omega", "zeta w1 never", "never omega", "w70 alone w3", "", None]
    plain = Plain(texts, 0)
    assert plain.n > 200_000
    model = K.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    df = spark.createDataFrame(list(enumerate(asks)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in K.score(df, model, buckets=5).collect()}
    for i, text in enumerate(asks):
        assert got[i]["score"] == pytest.approx(plain.score(text), abs=1e-8), text
        assert got[i]["base_score"] == pytest.approx(plain.base(text), abs=1e-8)
    assert got[0]["score"] > got[1]["score"] + 1


@pytest.mark.parametrize("vocabulary", [1e-5, 0.01, 0.2])
@pytest.mark.parametrize("texts", [corpus(1), corpus(5, 400, 9), ["a b a b a b"] * 9, ["a"], [""]])
def test_probabilities_add_up_to_one(texts, vocabulary):
    plain = Plain(texts, vocabulary)
    for h in ["<s>", "never", *plain.c]:
        if h != "</s>":
            total = sum(plain.p(h, w) for w in plain.c) + plain.p(h, "another one")
            assert total == pytest.approx(1, abs=1e-9)


def test_discounts_stay_good_turing():
    def turing(n, r):
        tail = 6 * n[6] / n[1]
        return ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail)
    n = [0, 1000, 300, 150, 60, 70, 40]  # the factor of 4 is over 1
    assert turing(n, 4) > 1
    d = K.discounts(n)
    for r in (1, 2, 3, 5):
        assert d[r] == pytest.approx(turing(n, r))
    assert 0 < d[4] < 1
    for n in ([0, 9, 0, 0, 0, 0, 0], [0, 1, 1, 1, 1, 1, 1], [0, 1, 5, 9, 9, 20, 90],
              [0, 50, 0, 7, 0, 0, 3], [0, 10**9, 10**8, 10**8, 0, 1, 0]):
        assert ((K.discounts(n)[1:] > 0) & (K.discounts(n)[1:] <= 1)).all()
    law = [0] + [10**9 / r**2 for r in range(1, 7)]
    assert K.discounts(law)[1:] == pytest.approx([turing(law, r) for r in range(1, 6)])


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    from cumulus.llm.queries import op9_lm_scoring
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = op9_lm_scoring(spark, sf).collect()
    assert len(rows) == len(docs)
    train = [t for k, t in docs.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    c = Counter(w for t in train for w in split(t))
    n = sum(c.values())
    for r in rows:
        ws = split(docs[r["doc_id"]])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["train_tokens"], r["n_tokens"]) == (n, len(ws))
        base = sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r["held_out"]]
    known = [r for r in held if r["n_known"] == r["n_tokens"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_nothing_to_learn_from_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = K.train(none)
    big = 2**60 + 1
    df = spark.createDataFrame([(1, "a b"), (big, None), (None, "")], "doc_id long, text string")
    got = K.score(df.coalesce(1), model).orderBy("doc_id").collect()
    assert list(map(tuple, got)) == [(None, 1, 0, 0.0, 0.0), (1, 3, 0, 0.0, 0.0), (big, 1, 0, 0.0, 0.0)]
    assert K.score(none, K.train(df)).count() == 0


def test_many_batches(spark, monkeypatch):
    import numpy as np
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    a, b, c = K._unpack(K._pack(keys, np.arange(1000), np.arange(1000) * 7), 2)
    assert (a == keys).all() and (b == np.arange(1000)).all() and (c == np.arange(1000) * 7).all()
