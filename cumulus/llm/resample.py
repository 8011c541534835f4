"""Importance resampling towards a target distribution.

Texts are bags of word n-grams hashed into buckets.  A bucket's gain is the log
ratio of its smoothed share in the target texts to that in the raw texts; a
document's weight is the sum of its features' gains.  Gumbel noise, fixed by the
seed and the document's id, is added to the weight, and the greatest scores are
drawn: sampling without replacement with odds in proportion to exp(weight).

Features are found by batch concatenation: a batch's texts are joined with a
separator, one regular expression pass finds all words, ``searchsorted`` in the
documents' offsets tells whose each word is, n-grams over two documents are
masked, and the buckets are counted by ``bincount``.

Two passes over the texts: one counts buckets (per task one row for each bucket
used), one weighs documents.  Only the counts, one number for each bucket, come
to the driver.  Ranks come from a range sort of four numbers per document, which
is written once; the driver sees the row count of each of its parts.

Defined results: a null or blank text has no words, features or weight (0), and
takes no part in the draw.  Equal scores are ordered by key, null keys last, then
by place in the input; repeated rows are counted, scored and drawn each for
itself.  A null key is hashed as an empty text.  With no target texts every share
there is that of an empty table (the smoothing alone).  An empty table gives an
empty result.  Texts are read whole, other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import stored

# Words of lower-cased UTF-8: digits, a-z and every byte of a non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SEPARATOR = b"\n"
JOINED = 1 << 22       # bytes joined at once; a longer text is cut between words

NGRAM, BUCKETS, SHARE, SEED, LEAST_WORDS = 1, 10_000, 10, 2024, 20


def _joined(texts: list, limit: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """(rows, pieces) of about ``limit`` bytes.  Texts over it are cut between words."""
    rows, pieces, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = at + limit - size
            if end < len(text):
                gap = BREAK.search(text, end)
                end = gap.start() if gap else len(text)
            rows.append(row)
            pieces.append(text[at:end])
            size += min(end, len(text)) - at
            at = end
            if size >= limit:
                yield rows, pieces
                rows, pieces, size = [], [], 0
    if pieces:
        yield rows, pieces


def features(texts: list, ngram: int = NGRAM, limit: int = JOINED,
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each word, row of each feature, crc32 of each feature) of UTF-8 texts.

    A feature is a run of 1 to ``ngram`` words of one text, joined by a space."""
    tail, tail_rows = [], np.zeros(0, np.int64)
    for rows, pieces in _joined(texts, limit):
        found = [(m.start(), m.group()) for m in WORD.finditer(SEPARATOR.join(pieces).lower())]
        starts = np.fromiter((s for s, _ in found), np.int64, len(found))
        offsets = np.cumsum([0] + [len(p) + len(SEPARATOR) for p in pieces[:-1]])
        own = np.asarray(rows, np.int64)[np.searchsorted(offsets, starts, side="right") - 1]
        # The last words of the batch before open the runs that reach into this one.
        words, row = tail + [w for _, w in found], np.concatenate([tail_rows, own])
        known = len(tail)
        run = [crc32(w) for w in words]
        out_rows, out = [own], [np.asarray(run[known:], np.int64)]
        for n in range(2, ngram + 1):
            run = [crc32(b" " + w, c) for c, w in zip(run, words[n - 1:])]
            whole = row[: len(run)] == row[n - 1: n - 1 + len(run)]
            whole &= np.arange(len(run)) + n - 1 >= known
            out_rows.append(row[: len(run)][whole])
            out.append(np.asarray(run, np.int64)[whole])
        yield own, np.concatenate(out_rows), np.concatenate(out)
        if ngram > 1:
            tail, tail_rows = words[1 - ngram:], row[1 - ngram:]


def _texts(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def bucket_counts(df: DataFrame, text: str = "text", ngram: int = NGRAM,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket used."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, crc in features(_texts(batch.column(0)), ngram):
                total += np.bincount(crc % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    parts = df.select(F.col(f"`{text}`").alias("t")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the raw texts."""
    size, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.asarray([math.floor(1000 * math.log(
        (t + 1) * (all_raw + size) / ((s + 1) * (all_target + size))))
        for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def learn(docs: DataFrame, target: DataFrame, text: str = "text", ngram: int = NGRAM,
          buckets: int = BUCKETS) -> np.ndarray:
    """The buckets' gains of target texts over documents."""
    def counts(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(df, text, ngram, buckets).collect():
            out[bucket] = n
        return out
    return gains(counts(docs), counts(target))


def weigh(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text",
          ngram: int = NGRAM) -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, found, weight = (np.zeros(n, np.int64) for _ in range(3))
            for word_rows, rows, crc in features(_texts(batch.column(1)), ngram):
                words += np.bincount(word_rows, minlength=n)
                found += np.bincount(rows, minlength=n)
                # Sums of whole numbers: exact in doubles far beyond any text's length.
                weight += np.bincount(rows, gain[crc % len(gain)], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(found), pa.array(weight)],
                [key, "n_words", "n_features", "weight"])

    out = T.StructType([T.StructField(key, df.schema[key].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    return df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("__t")).mapInArrow(
        weights, out)


def noise(key: Column, seed: int = SEED) -> Column:
    """1000 times standard Gumbel noise, rounded down, from the key's sha256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(weighed: DataFrame, key: str = "doc_id", share: int = SHARE, seed: int = SEED,
         least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank): ``share`` percent of the rows
    with ``least_words`` words are drawn and ranked from 1; the others' rank is null."""
    rows = stored(weighed.withColumn("score", F.col("weight") + noise(F.col(f"`{key}`"), seed))
                  .withColumn("__at", F.monotonically_increasing_id()), "resample_scores")
    able = F.col("n_words") >= least_words
    # Rows that take no part sort behind all others, so a place in the order is a rank.
    # The last sort key differs from row to row: borders fall anywhere, also among ties.
    ordered = rows.orderBy(able.desc(), F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last(),
                           "__at")
    placed = stored(ordered.drop("__at").withColumn("__place", F.monotonically_increasing_id()),
                    "resample_order")
    part = F.shiftright("__place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)), F.sum(able.cast("long"))).collect())
    before, seen, n = [], 0, 0
    for number, size, able_rows in sizes:
        before.append((number, seen))
        seen, n = seen + size, n + able_rows
    starts = rows.sparkSession.createDataFrame(before, "__part long, __before long")
    place = F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # One row for each part of the sort.
    return (placed.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn("rank", F.when(able & (place <= F.lit(share * n // 100)), place))
            .select(F.col(f"`{key}`").alias(key), "n_words", "n_features", "weight", "score", "rank"))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             ngram: int = NGRAM, buckets: int = BUCKETS, share: int = SHARE, seed: int = SEED,
             least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document's features, weight, score and rank in the draw towards ``target``."""
    gain = learn(docs, target, text, ngram, buckets)
    return draw(weigh(docs, gain, key, text, ngram), key, share, seed, least_words)
