"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point.  The
vector of an n-gram binds its letters: the element-wise product of the letter
vectors, each rotated by its place.  A text, and a language's training texts
together, are the sum (bundle) of their n-gram vectors; a text gets the
language whose prototype has the largest cosine with it.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text when there is nothing to learn from.  Rows with a null text or
language teach nothing.  Equal cosines go to the smaller language name.  Repeated
rows count as often as they occur.  Texts of any length are read whole; their
memory is that of one text and one block of n-gram vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

DIM = 1024          # elements of a vector
GRAM = 3            # letters of an n-gram; a word's ends count as a letter
SEED = 20
MAX_LANGUAGES = 1000  # prototypes go to every task: at most this many are learned
BLOCK = 1024        # n-gram vectors held as floats at once
CACHE = 65_536      # n-gram vectors kept (1 byte an element)
DOCS = 64           # texts counted or bundled at once
SHIFT = 21          # bits of a code point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower case of every code point that is a letter, 0 for all others."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(text: str | None, n: int = GRAM) -> np.ndarray:
    """Packed n-grams of a text: letters in lower case, anything else a word end."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    low = np.concatenate(([0], _letters()[points], [0])).astype(np.uint64)
    low = low[np.concatenate(([True], (low[1:] != 0) | (low[:-1] != 0)))]
    if len(low) < 2 or not low.any():
        return np.empty(0, np.uint64)
    if len(low) < n:
        low = np.concatenate((low, np.zeros(n - len(low), np.uint64)))
    out = np.zeros(len(low) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = (out << np.uint64(SHIFT)) | low[k:len(low) - n + 1 + k]
    return out


class Space:
    """The random vectors, made when first needed; the same in every process."""

    def __init__(self, dim: int = DIM, n: int = GRAM, seed: int = SEED):
        self.dim, self.n, self.seed = dim, n, seed
        self.rows: dict[int, int] = {}
        self.kept = np.empty((0, dim), np.int8)

    @lru_cache(maxsize=4096)
    def letter(self, point: int) -> np.ndarray:
        bits = np.random.default_rng([self.seed, point]).integers(0, 2, self.dim)
        return (2 * bits - 1).astype(np.int8)

    def bind(self, gram: int) -> np.ndarray:
        out = np.ones(self.dim, np.int8)
        for place in range(self.n):
            point = (gram >> (SHIFT * place)) & ((1 << SHIFT) - 1)
            out *= np.roll(self.letter(point), place)
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row for each code; at most BLOCK codes."""
        codes = codes.tolist()
        if len(self.rows) + len(codes) > CACHE:
            self.rows, self.kept = {}, self.kept[:0]
        new = [g for g in codes if g not in self.rows]
        if new:
            at = len(self.rows)
            if at + len(new) > len(self.kept):
                grown = np.empty((min(CACHE, 2 * (at + len(new))), self.dim), np.int8)
                grown[:at] = self.kept[:at]
                self.kept = grown
            for i, g in enumerate(new):
                self.kept[at + i] = self.bind(g)
                self.rows[g] = at + i
        return self.kept[[self.rows[g] for g in codes]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sums of n-gram vectors: counts (texts x codes) times vectors."""
        out = np.zeros((len(counts), self.dim), counts.dtype)
        for i in range(0, len(codes), BLOCK):
            out += counts[:, i:i + BLOCK] @ self.vectors(codes[i:i + BLOCK]).astype(counts.dtype)
        return out


def learn(df: DataFrame, text: str = "text", lang: str = "lang", *, dim: int = DIM,
          n: int = GRAM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype of each language: the exact bundle of all its training texts.

    n-grams are counted by language in Spark; only the prototypes, at most
    MAX_LANGUAGES vectors, come to the driver.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, texts in pdf.groupby("lang")["text"]:
                parts = [np.unique(np.concatenate([grams(t, n) for t in texts.iloc[i:i + DOCS]]),
                                   return_counts=True) for i in range(0, len(texts), DOCS)]
                codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([m for _, m in parts]), len(codes))
                yield pd.DataFrame({"lang": name, "gram": codes.astype(np.int64),
                                    "n": counts.astype(np.int64)})

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, sums = Space(dim, n, seed), {}
        for pdf in batches:
            for name, part in pdf.groupby("lang"):
                codes = part["gram"].to_numpy().astype(np.uint64)
                got = sums.setdefault(name, np.zeros(dim, np.int64))
                for i in range(0, len(codes), BLOCK):
                    counts = part["n"].to_numpy()[i:i + BLOCK]
                    got += counts @ space.vectors(codes[i:i + BLOCK]).astype(np.int64)
        for name, v in sums.items():
            yield pd.DataFrame({"lang": [name], "v": [v.tolist()]})

    rows = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).dropna()
    counted = (rows.mapInPandas(count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    sums = (counted.mapInPandas(bundle, "lang string, v array<long>")
            .select("lang", F.posexplode("v").alias("i", "x"))
            .groupBy("lang", "i").agg(F.sum("x").alias("x")))
    out: dict[str, np.ndarray] = {}
    for r in sums.limit(MAX_LANGUAGES * dim + 1).collect():
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["x"]
        if len(out) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {k: out[k] for k in sorted(out) if out[k].any()}


def predict(text: Column | str, prototypes: dict[str, np.ndarray], *, dim: int = DIM,
            n: int = GRAM, seed: int = SEED) -> Column:
    """struct(lang, score): the nearest prototype and its cosine, 0 at least."""
    names = list(prototypes)
    units = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names])

    @F.pandas_udf("lang string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(dim, n, seed)
        for texts in batches:
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            for i in range(0, len(texts) if names else 0, DOCS):
                each = [np.unique(grams(t, n), return_counts=True) for t in texts.iloc[i:i + DOCS]]
                codes = np.unique(np.concatenate([c for c, _ in each]))
                counts = np.zeros((len(each), len(codes)), np.float32)
                for k, (c, m) in enumerate(each):
                    counts[k, np.searchsorted(codes, c)] = m
                v = space.bundle(codes, counts)
                size = np.linalg.norm(v, axis=1)
                cos = (v @ units.T) / np.where(size == 0, 1, size)[:, None]
                for k, best in enumerate(np.argmax(cos, axis=1)):
                    if len(each[k][0]):
                        langs[i + k] = names[best]
                        scores[i + k] = min(1.0, max(0.0, cos[k, best]))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return nearest(F.col(text) if isinstance(text, str) else text)
