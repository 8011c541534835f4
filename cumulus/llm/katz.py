"""Katz backoff language model, trained and applied as Spark jobs.

Tokens are the words of a text (A-Z in lower case) and one end.  The model is a
bigram over all words: a seen pair has its Good-Turing discounted count, an unseen
one the backoff weight of its first word times the next lower order.  The lowest
order gives every word its own discounted probability and the words never seen
the mass left over.  Weights are computed so that the probabilities after every
word add up to exactly one.  Only where a caller gives ``vocabulary``, the words
below that frequency share one class in the pairs.

Words are numbered by frequency, so a word's number tells its count (by one table of
the different counts), and a pair is one number that packs well.  Texts become numbers
once: a task knows those of frequent words and asks the bucket of each other word.

Tables in the shared folder, partitioned by bucket: the words' numbers; the pairs and
their counts; the backoff weights of first words.  All pairs of a first word that is
not frequent lie in its bucket, those of frequent ones are spread by pair.  At most
1 / VOCABULARY words, and pairs, can be frequent: their weights and counts go to every
task.  The other pairs of a text travel, packed, to their bucket and come back as a sum
per document.  No word or pair is a hot key then.

Defined results: a null or empty text is an end alone.  Repeated rows and ids
are scored, and counted in training, as often as they occur.  With nothing to
learn from every token is unseen and has probability 1.  Texts are read whole.
An empty table gives an empty result.  Up to four thousand million different words.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..operators.series import INDEX, indexed
from .common import drop, stored

LARGEST = 5            # counts up to this are discounted
VOCABULARY = 1e-5      # frequency from which a word, or a pair, goes to every task
BUCKET = 4_000_000     # tokens aimed at in a bucket
BATCH = 500_000        # tokens numbered, or scored, together before they are sent
TYPES = 750_000        # different words or pairs a task counts at once

END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word holds a line feed
META, TABLE, WEIGHTS, ASKED = range(4)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, and of its end."""
    # bytes.lower() changes A-Z only, bytes.split() splits at U+0009..U+000D and space.
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, ws)), dtype=">u8").astype(np.uint64)
    return np.append(h, END)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing factors d[r] for counts r = 0..LARGEST, from n[r], the number of
    types seen r times, r up to LARGEST + 1; d[0] is not used.

    Where a factor falls outside (0, 1], as n[r] is too rough, that factor alone is
    taken from smoothed n[r]: the line through log n[r] over log r, as in Simple
    Good-Turing.  Its factors always lie in (0, 1).
    """
    d = np.ones(LARGEST + 1)
    if not n[1]:
        return d
    r = np.arange(1, LARGEST + 1)
    seen = np.array([i for i in range(1, LARGEST + 2) if n[i]])
    # Smoothed: n[r] = c * r ** slope, so (r + 1) n[r + 1] / n[r] / r = (1 + 1 / r) ** x
    # with x = slope + 1.  One point makes no line: 1 / r ** 2, as of Zipf's law, then.
    slope = np.polyfit(np.log(seen), np.log([n[i] for i in seen]), 1)[0] if len(seen) > 1 else -2.0
    x = min(slope + 1, -1e-3)
    smooth_tail = (LARGEST + 1) ** x
    smooth = ((1 + 1 / r) ** x - smooth_tail) / (1 - smooth_tail)
    tail = (LARGEST + 1) * n[LARGEST + 1] / n[1]
    for i in r:
        good = n[i] and tail < 1
        own = ((i + 1) * n[i + 1] / n[i] / i - tail) / (1 - tail) if good else 0
        d[i] = own if 0 < own <= 1 else smooth[i - 1]
    return d


def _factor(d: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(n > LARGEST, 1.0, d[np.minimum(n, LARGEST)])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the sums of their n."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n[order], first)


def _tallies(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of all parts, added up as far as TYPES different keys allow."""
    wait: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return _added(*map(np.concatenate, zip(*wait)))
    for part in parts:
        wait.append(_added(part, np.ones(len(part), np.int64)))
        size += len(wait[-1][0])
        if size > 2 * TYPES:
            wait = [joined()]
            if len(wait[0][0]) > TYPES:
                yield wait.pop()
            size = sum(len(k) for k, _ in wait)
    if wait:
        yield joined()


def _counted(df: DataFrame, text: str) -> DataFrame:
    """(key, n) of all words; a task sums its own before they are shuffled."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = (np.concatenate([tokens(t) for t in pdf["text"]]) for pdf in batches if len(pdf))
        for keys, n in _tallies(parts):
            yield pd.DataFrame({"key": _signed(keys), "n": n})

    return (df.select(F.col(f"`{text}`").alias("text"))
            .mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))


def _small(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _large(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte planes apart."""
    return _small(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _flat(data: bytes) -> np.ndarray:
    raw = np.frombuffer(_large(data), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(raw).view("<u4")[:, 0].astype(np.int64)


def _pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys by their differences, and 32-bit columns, byte planes apart."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = [x.view(np.uint8).reshape(len(keys), -1).T.tobytes()
              for x in (steps, *(c.astype("<u4") for c in columns))]
    return _small(b"".join(planes))


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    raw = _large(data)
    n = len(raw) // (8 + 4 * columns)
    out = []
    for i, (kind, width) in enumerate([("<u8", 8)] + [("<u4", 4)] * columns):
        start = n * (8 + 4 * (i - 1)) if i else 0
        part = np.frombuffer(raw, np.uint8, n * width, start).reshape(width, n).T
        out.append(np.ascontiguousarray(part).view(kind)[:, 0])
    return [np.cumsum(out[0], dtype=np.uint64), *[c.astype(np.int64) for c in out[1:]]]


def _deal(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)


def _dealt(bucket: np.ndarray, keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed) of keys that are sorted."""
    if not len(keys):
        return
    order = np.argsort(bucket.astype(np.uint16 if bucket.max() < 1 << 16 else np.int64), kind="stable")
    bucket = bucket[order].astype(np.int64)
    begins = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for i, j in zip(begins, [*begins[1:], len(bucket)]):
        at = order[i:j]
        yield int(bucket[i]), _pack(keys[at], *[c[at] for c in columns])


def _halves(x: np.ndarray) -> list[np.ndarray]:
    """64-bit numbers as two columns of 32 bits."""
    x = np.ascontiguousarray(x).view(np.uint64)
    return [x & np.uint64(0xffffffff), x >> np.uint64(32)]


def _whole(low: np.ndarray, high: np.ndarray, kind: type) -> np.ndarray:
    return (low | high << 32).view(kind)


@dataclass
class Numbers:
    """What every task knows of a model."""
    total: int = 0                  # training tokens
    types: int = 0                  # different ones; also the number of any word not among them
    vocab: int = 0                  # words with numbers below this are frequent; 0 is the end
    classed: bool = False           # the others share one class in the pairs
    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # of these, sorted
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))      # their numbers
    ends: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))     # of equal counts
    counts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    word_d: np.ndarray | None = None
    pair_d: np.ndarray | None = None
    scale: float = 1.0              # of word probabilities
    unseen: float = 1.0             # mass of words never seen
    rest: float = 1.0               # probability of the class
    held: np.ndarray | None = None    # by frequent first word: what counts are divided by,
    weight: np.ndarray | None = None  # and log10 of its backoff weight
    hot: np.ndarray | None = None     # frequent pairs, sorted,
    hot_gain: np.ndarray | None = None  # and what they have over backing off

    @property
    def firsts(self) -> int:
        """First words, by number and one, that are known everywhere; 0 is the start."""
        return self.vocab + 1 + self.classed

    def group(self, ids: np.ndarray) -> np.ndarray:
        """Which of ``counts`` words have."""
        return np.searchsorted(self.ends, ids, side="right")

    def probabilities(self) -> np.ndarray:
        """Lowest-order probability of a word with each of ``counts``."""
        n = self.counts
        return np.where(n > 0, self.scale * _factor(self.word_d, n) * n / max(1, self.total), self.unseen)

    def probability(self, ids: np.ndarray) -> np.ndarray:
        return self.probabilities()[self.group(ids)]

    def named(self, ids: np.ndarray) -> np.ndarray:
        """What words are in the pairs: themselves, or the class they belong to."""
        return np.minimum(ids, self.vocab) if self.classed else ids

    def firsts_of(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The first of the pair that each (named) token makes with the one before: its
        number and one; the tokens at ``begins`` follow the start."""
        first = np.concatenate(([0], ids[:-1] + 1))
        first[begins] = 0
        return first

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Pairs as one number each."""
        return first.astype(np.uint64) * np.uint64(self.types + 2) + second.astype(np.uint64)

    def split(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = pairs // np.uint64(self.types + 2)
        return first.astype(np.int64), (pairs - first * np.uint64(self.types + 2)).astype(np.int64)

    def bucket(self, pairs: np.ndarray, buckets: int, first: np.ndarray | None = None) -> np.ndarray:
        first = self.split(pairs)[0] if first is None else first
        return _deal(np.where(first < self.firsts, pairs, first.astype(np.uint64)), buckets)

    def second(self, ids: np.ndarray) -> np.ndarray:
        """Probability of the second of a pair: of the class, where it is that."""
        p = self.probability(ids)
        return np.where(ids == self.vocab, self.rest, p) if self.classed else p

    def gain(self, second: np.ndarray, n: np.ndarray, held: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """log10 of what a seen pair has over backing off."""
        return (np.log10(_factor(self.pair_d, n) * n) - np.log10(held) - weight
                - np.log10(self.second(second)))


@dataclass
class Model:
    words: DataFrame      # bucket, blob: hashes and numbers of words that are not frequent
    pairs: DataFrame      # bucket, blob: pairs and counts
    weights: DataFrame    # bucket, blob: first words, what counts are divided by, log10 of weights
    buckets: int
    numbers: Numbers
    training: DataFrame | None = None   # ids: the texts' numbers, where they are kept

    @property
    def total(self) -> int:
        return self.numbers.total


def _batches(batches: Iterator[pd.DataFrame], column: str, read) -> Iterator[tuple[list, list]]:
    """(keys, arrays) of texts, BATCH tokens or a little more together."""
    keys, wait, size = [], [], 0
    for pdf in batches:
        for k, x in zip(pdf["key"], pdf[column]):
            keys.append(k)
            wait.append(read(x))
            size += len(wait[-1])
            if size >= BATCH:
                yield keys, wait
                keys, wait, size = [], [], 0
    if wait:
        yield keys, wait


def _first_batch() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId() << 32


SENT = "bucket long, role int, batch long, part long, blob binary"


def _numbered(df: DataFrame, key: str, text: str, words: DataFrame, numbers: Numbers,
              buckets: int) -> DataFrame:
    """(key as text, n_tokens, ids): the numbers of every text's tokens, packed."""
    small = Numbers(types=numbers.types, vocab=numbers.vocab, hashes=numbers.hashes, ids=numbers.ids)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = _first_batch()
        for keys, wait in _batches(batches, "text", tokens):
            h = np.concatenate(wait)
            at = np.minimum(np.searchsorted(small.hashes, h), max(0, len(small.hashes) - 1))
            known = small.hashes[at] == h if len(small.hashes) else np.zeros(len(h), bool)
            rare, which = np.unique(h[~known], return_inverse=True)
            bucket = _deal(rare, buckets)
            order = np.lexsort((rare, bucket))
            place = np.empty(len(rare), np.int64)
            place[order] = np.arange(len(rare))
            codes = np.empty(len(h), np.int64)       # a number, or vocab + place among the asked
            codes[known] = small.ids[at[known]]
            codes[~known] = small.vocab + place[which]
            rows = [(-1 - batch, META, batch, -1, pickle.dumps((
                _small(pickle.dumps(keys)), np.array([len(x) for x in wait], "<u4"),
                _planes(codes))))]
            rows += [(b, ASKED, batch, b, x) for b, x in _dealt(bucket, rare)]
            yield pd.DataFrame(rows, columns=["bucket", "role", "batch", "part", "blob"])
            batch += 1

    def look_up(pdf: pd.DataFrame) -> pd.DataFrame:
        meta, role = pdf[pdf["role"] == META], pdf["role"]
        known, ids = _table(pdf["blob"][role == TABLE])
        out = []
        for batch, part, blob in pdf[role == ASKED][["batch", "part", "blob"]].itertuples(index=False):
            asked = _unpack(blob, 0)[0]
            found = np.full(len(asked), small.types)
            if len(known):
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                found = np.where(known[at] == asked, ids[at], small.types)
            out.append((batch, part, _planes(found)))
        return pd.concat([meta[["batch", "part", "blob"]],
                          pd.DataFrame(out, columns=["batch", "part", "blob"])])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        keys, sizes, codes = pickle.loads(pdf["blob"].iloc[0])
        asked = [_flat(x) for x in pdf["blob"].iloc[1:]]
        ids = np.concatenate([np.arange(small.vocab), *asked])[_flat(codes)]
        parts = np.split(ids, np.cumsum(sizes.astype(np.int64))[:-1])
        return pd.DataFrame({"key": pd.Series(pickle.loads(_large(keys)), dtype=object),
                             "n_tokens": sizes.astype(np.int64), "ids": [_planes(x) for x in parts]})

    # The key travels as text: pandas would make numbers with nulls inexact.
    sent = df.select(F.col(f"`{key}`").cast("string").alias("key"),
                     F.col(f"`{text}`").alias("text")).mapInPandas(send, SENT)
    held = words.select("bucket", F.lit(TABLE).alias("role"), F.lit(0).cast("long").alias("batch"),
                        F.lit(0).cast("long").alias("part"), "blob")
    return (sent.unionByName(held).groupBy("bucket")
            .applyInPandas(look_up, "batch long, part long, blob binary").groupBy("batch")
            .applyInPandas(finish, "key string, n_tokens long, ids binary"))


def _table(blobs, columns: int = 1) -> list[np.ndarray]:
    """Keys, sorted, and columns of packed tables."""
    got = [_unpack(b, columns) for b in blobs]
    out = [np.concatenate([g[i] for g in got]) if got else np.empty(0, np.int64 if i else np.uint64)
           for i in range(columns + 1)]
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _word_blobs(words: DataFrame, numbers: Numbers, buckets: int) -> DataFrame:
    """(bucket, blob): hashes and numbers of the words that are not frequent."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["key"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(keys)
            keys, ids = keys[order], pdf["id"].to_numpy(np.int64)[order]
            got = _dealt(_deal(keys, buckets), keys, ids)
            yield pd.DataFrame(list(got), columns=["bucket", "blob"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "blob": [_pack(*_table(pdf["blob"]))]})
    return (words.filter(F.col("id") >= numbers.vocab).select("key", "id")
            .mapInPandas(deal, "bucket long, blob binary")
            .groupBy("bucket").applyInPandas(merge, "bucket long, blob binary"))


def _pair_blobs(ids: DataFrame, numbers: Numbers, buckets: int) -> DataFrame:
    """(bucket, blob, seen): pairs and counts, and how many were seen 1, 2, ... times."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[np.ndarray]:
            for pdf in batches:
                got = [_flat(x) for x in pdf["ids"]]
                if got:
                    ids = numbers.named(np.concatenate(got))
                    begins = np.cumsum([0] + [len(x) for x in got[:-1]])
                    yield numbers.pair(numbers.firsts_of(ids, begins), ids)
        for keys, n in _tallies(parts()):
            yield pd.DataFrame(list(_dealt(numbers.bucket(keys, buckets), keys, n)),
                               columns=["bucket", "blob"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _added(*map(np.concatenate, zip(*[_unpack(b, 1) for b in pdf["blob"]])))
        seen = np.bincount(n[n <= LARGEST + 1], minlength=LARGEST + 2)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "blob": [_pack(keys, n)],
                             "seen": [seen.tolist()]})
    return (ids.select("ids").mapInPandas(deal, "bucket long, blob binary")
            .groupBy("bucket").applyInPandas(merge, "bucket long, blob binary, seen array<long>"))


def _weighed(n, held, p, types, numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """What a first word's counts are divided by, and log10 of its backoff weight."""
    # No mass left over, as no count was small: one more event makes room for it.
    n = np.where(n - held < 1e-9 * n, n + 1, n)
    weight = np.log10((1 - held / n) / np.maximum(1 - p, 1e-300))
    if numbers.classed:    # every class followed: nothing is left to back off to
        every = types == numbers.vocab + 1
        n, weight = np.where(every, held, n), np.where(every, 0.0, weight)
    return n, weight


def _weight_rows(pairs: DataFrame, numbers: Numbers) -> DataFrame:
    """For each bucket a blob with the weights of its own first words, and a row of sums
    for each frequent first word."""
    columns = ["bucket", "blob", "first", "n", "held", "p", "types"]

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for bucket, blob in zip(pdf["bucket"], pdf["blob"]):
                keys, n = _unpack(blob, 1)
                first, second = numbers.split(keys)
                new = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
                of = [np.add.reduceat(x, new) for x in (
                    n, _factor(numbers.pair_d, n) * n, numbers.second(second), np.ones(len(n), np.int64))]
                first = first[new]
                own = first >= numbers.firsts
                held, weight = _weighed(*[x[own] for x in of], numbers)
                if own.any():
                    blob = _pack(first[own].astype(np.uint64), *_halves(held.astype(float)), *_halves(weight))
                    yield pd.DataFrame([(bucket, blob)], columns=columns[:2]).reindex(columns=columns)
                yield pd.DataFrame(dict(zip(columns, (
                    bucket, None, first[~own], *[x[~own] for x in of]))))[columns]

    return pairs.select("bucket", "blob").mapInPandas(
        weigh, "bucket long, blob binary, first long, n long, held double, p double, types long")


def train(df: DataFrame, text: str = "text", *, vocabulary: float | None = None,
          keep_numbers: bool = False) -> Model:
    """Counts, discounts and backoff weights from all texts of ``df``; words below
    the frequency ``vocabulary``, where given, share one class in the pairs.
    ``keep_numbers``: the model keeps the texts' numbers, for orders above pairs."""
    spark, classed = df.sparkSession, vocabulary is not None
    end = F.lit(int(_signed(np.array([END]))[0]))
    counted = stored(_counted(df, text), "words")
    size = counted.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")).first()
    total, types = size["total"] or 0, size["types"]
    counts = [(r["n"], r["types"], r["end"]) for r in counted.groupBy(
        "n", (F.col("key") == end).alias("end")).agg(F.count(F.lit(1)).alias("types")).collect()]
    counts.sort(key=lambda r: (not r[2], -r[0]))     # the end's number is 0, then by frequency
    word_n = [sum(t for n, t, _ in counts if n == r) for r in range(LARGEST + 2)]
    word_d = discounts(word_n)
    unseen = sum(word_n[r] * r * (1 - word_d[r]) for r in range(1, LARGEST + 1)) / max(1, total)
    scale = 1.0
    if unseen <= 0:
        scale, unseen = total / (total + 1), 1 / (total + 1)
    least = max(1, (vocabulary if classed else VOCABULARY) * total)
    numbers = Numbers(
        total, types, sum(t for n, t, is_end in counts if is_end or n >= least), classed,
        ends=np.cumsum([t for _, t, _ in counts]).astype(np.int64),
        counts=np.array([n for n, _, _ in counts] + [0], np.int64), word_d=word_d, scale=scale,
        unseen=unseen)
    ranked = indexed(counted, [(F.col("key") != end), F.col("n").desc(), "key"], "word_numbers") \
        .withColumnRenamed(INDEX, "id")
    frequent = ranked.filter(F.col("id") < numbers.vocab).select("key", "id").toPandas()
    hashes = frequent["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    numbers.hashes, numbers.ids = hashes[order], frequent["id"].to_numpy(np.int64)[order]
    numbers.rest = max(unseen, 1 - numbers.probability(np.arange(numbers.vocab)).sum()) if classed else unseen

    buckets = max(1, -(-total // BUCKET))
    words = stored(_word_blobs(ranked, numbers, buckets), "word_blobs")
    drop(spark, counted, ranked, shuffles=True)
    keyed = df.select(F.lit(None).cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    ids = stored(_numbered(keyed, "key", "text", words, numbers, buckets), "training_numbers")
    drop(spark, shuffles=True)
    pairs = stored(_pair_blobs(ids, numbers, buckets), "pairs")
    if not keep_numbers:
        drop(spark, ids, shuffles=True)
    seen = [r["seen"] for r in pairs.select("seen").collect()]
    numbers.pair_d = discounts(np.sum(seen, axis=0).tolist() if seen else [0] * (LARGEST + 2))

    rows = stored(_weight_rows(pairs, numbers), "weights")
    sums = rows.filter("blob IS NULL").groupBy("first").agg(
        *[F.sum(c).alias(c) for c in ("n", "held", "p", "types")]).toPandas()
    numbers.held, numbers.weight = np.ones(numbers.firsts), np.zeros(numbers.firsts)
    at = sums["first"].to_numpy(np.int64)
    numbers.held[at], numbers.weight[at] = _weighed(
        *[sums[c].to_numpy(float) for c in ("n", "held", "p", "types")], numbers)
    numbers.hot, n = _hot(pairs, max(2, VOCABULARY * total), numbers)
    first, second = numbers.split(numbers.hot)
    numbers.hot_gain = numbers.gain(second, n, numbers.held[first], numbers.weight[first])
    return Model(words, pairs.select("bucket", "blob"),
                 rows.filter("blob IS NOT NULL").select("bucket", "blob"), buckets, numbers,
                 ids if keep_numbers else None)


def _hot(pairs: DataFrame, least: float, numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of frequent first words seen ``least`` times: few, by their share."""
    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for blob in pdf["blob"]:
                keys, n = _unpack(blob, 1)
                keep = (n >= least) & (numbers.split(keys)[0] < numbers.firsts)
                yield pd.DataFrame({"key": _signed(keys[keep]), "n": n[keep]})
    got = pairs.select("blob").mapInPandas(pick, "key long, n long").toPandas()
    keys = got["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], got["n"].to_numpy(np.int64)[order]


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", *,
          buckets: int | None = None, vocabulary: float | None = None) -> DataFrame:
    """key, n_tokens, n_known, base_score (unigrams, one added to every count) and
    score (this model), both log10: one row per row of ``df``.  ``vocabulary`` is as in
    training, where it was fixed."""
    found = score_numbers(numbered(df, model, key, text), model, buckets)
    return found.select(F.col("key").cast(df.schema[key].dataType).alias(key),
                        "n_tokens", "n_known", "base_score", "score")


def numbered(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key as text, n_tokens, ids): the numbers of every text's tokens, packed, in a table."""
    return stored(_numbered(df, key, text, model.words, model.numbers, model.buckets), "numbers")


def score_numbers(ids: DataFrame, model: Model, buckets: int | None = None) -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of ``numbered`` texts."""
    numbers = model.numbers
    total, types = numbers.total, numbers.types
    size = ids.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = buckets or max(model.buckets, -(-size // BUCKET))
    drop(ids.sparkSession, shuffles=True)
    meta = ["key", "idx", "n_tokens", "n_known", "base", "score"]
    tail = "key string, idx int, n_tokens long, n_known long, base double, score double"
    order = ["bucket", "role", "batch", "blob", *meta]

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What is frequent is scored here; the other pairs are dealt to the buckets."""
        batch = _first_batch()
        low, base = np.log10(numbers.probabilities()), np.log10((numbers.counts + 1) / (total + types + 1))
        for keys, wait in _batches(batches, "ids", _flat):
            sizes = np.array([len(x) for x in wait])
            all_ids, doc = np.concatenate(wait), np.repeat(np.arange(len(wait)), sizes)
            second = numbers.named(all_ids)
            first = numbers.firsts_of(second, np.cumsum(sizes) - sizes)
            pairs = numbers.pair(first, second)
            group = numbers.group(all_ids)
            known, common = all_ids < types, first < numbers.firsts
            logs = low[group]
            logs[common] += numbers.weight[first[common]]
            at = np.minimum(np.searchsorted(numbers.hot, pairs), max(0, len(numbers.hot) - 1))
            hot = numbers.hot[at] == pairs if len(numbers.hot) else np.zeros(len(pairs), bool)
            logs[hot] += numbers.hot_gain[at[hot]]
            rows = [pd.DataFrame({
                "bucket": -1 - batch, "role": META, "batch": batch, "blob": None,
                "key": pd.Series(keys, dtype=object), "idx": np.arange(len(wait)), "n_tokens": sizes,
                "n_known": np.bincount(doc, known, len(wait)).astype(np.int64),
                "base": np.bincount(doc, base[group], len(wait)),
                "score": np.bincount(doc, logs, len(wait))})]
            # A word never seen is first in no pair, and second in none of a frequent word.
            ask = np.flatnonzero(~hot & (first <= types) & (known | ~common | numbers.classed))
            if len(ask):
                ask = ask[np.argsort(pairs[ask], kind="stable")]    # documents stay in order
                k, d = pairs[ask], doc[ask]
                new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]))))
                times, k = np.diff(np.append(new, len(k))), k[new]
                rows.append(pd.DataFrame([(b, ASKED, batch, x) for b, x in _dealt(
                    numbers.bucket(k, buckets, first[ask[new]]), k, d[new], times)], columns=order[:4]))
            yield pd.concat([r.reindex(columns=order) for r in rows])
            batch += 1

    def look_up(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sums per batch and document of the pairs whose counts lie in this bucket."""
        role = pdf["role"]
        out = [pdf[role == META][["batch", "blob", *meta]]]
        known, counts = _table(pdf["blob"][role == TABLE])
        owners, *halves = _table(pdf["blob"][role == WEIGHTS], 4)
        own_held, own_weight = _whole(*halves[:2], float), _whole(*halves[2:], float)
        for batch, blob in pdf[role == ASKED][["batch", "blob"]].itertuples(index=False):
            keys, doc, times = _unpack(blob, 2)
            first, second = numbers.split(keys)
            common = first < numbers.firsts
            held, weight = np.ones(len(keys)), np.zeros(len(keys))
            held[common], weight[common] = numbers.held[first[common]], numbers.weight[first[common]]
            if len(owners):
                at = np.minimum(np.searchsorted(owners, first.astype(np.uint64)), len(owners) - 1)
                mine = ~common & (owners[at] == first.astype(np.uint64))
                held[mine], weight[mine] = own_held[at[mine]], own_weight[at[mine]]
            logs = np.where(common, 0, weight)      # of frequent words it is in already
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                seen = known[at] == keys
                logs[seen] += numbers.gain(second[seen], counts[at[seen]], held[seen], weight[seen])
            docs, place = np.unique(doc, return_inverse=True)
            data = docs.astype("<u4").tobytes() + np.bincount(place, logs * times, len(docs)).tobytes()
            out.append(pd.DataFrame({"batch": [batch], "blob": [_small(data)]}))
        return pd.concat([x.reindex(columns=["batch", "blob", *meta]) for x in out])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf[pdf["blob"].isna()].sort_values("idx").reset_index(drop=True)
        logs = rows["score"].to_numpy(float).copy()
        for blob in pdf["blob"].dropna():
            raw = _large(blob)
            n = len(raw) // 12
            logs[np.frombuffer(raw, "<u4", n)] += np.frombuffer(raw, "<f8", n, 4 * n)
        return rows[["key", "n_tokens", "n_known", "base"]].assign(score=logs)

    def redeal(table: DataFrame, columns: int, by) -> DataFrame:
        """The blobs of a table for another number of buckets."""
        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for blob in pdf["blob"]:
                    keys, *cols = _unpack(blob, columns)
                    yield pd.DataFrame(list(_dealt(by(keys), keys, *cols)), columns=["bucket", "blob"])
        return table if buckets == model.buckets else table.mapInPandas(deal, "bucket long, blob binary")

    tables = [(TABLE, redeal(model.pairs, 1, lambda k: numbers.bucket(k, buckets))),
              (WEIGHTS, redeal(model.weights, 4, lambda k: _deal(k, buckets)))]
    together = ids.select("key", "ids").mapInPandas(
        send, "bucket long, role int, batch long, blob binary, " + tail)
    for role, table in tables:
        together = together.unionByName(table.select(
            "bucket", F.lit(role).alias("role"), F.lit(0).cast("long").alias("batch"), "blob"),
            allowMissingColumns=True)
    found = together.groupBy("bucket").applyInPandas(look_up, f"batch long, blob binary, {tail}")
    return found.groupBy("batch").applyInPandas(
        add_up, "key string, n_tokens long, n_known long, base double, score double").select(
        "key", "n_tokens", "n_known", F.col("base").alias("base_score"), "score")
