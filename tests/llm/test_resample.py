"""Importance resampling against a plain version: features, gains, scores, ranks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import queries, resample as R

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " .,- ", "one", "The the THE end " * 10, "Ünï ÜNÏ çà 日本語 x" * 7, "a b\x00c\nd " * 9,
         "alpha beta gamma " * 2000, "word" * 5000 + " tail", "same text of some words here " * 4,
         "same text of some words here " * 4]
TARGET = ["alpha beta the end", None, "ünï word"]


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def plain_features(text, ngram):
    w = plain_words(text)
    return [" ".join(w[i:i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, ngram=1, buckets=10_000, share=10, seed=2024, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in plain_features(t, ngram))
    t = Counter(bucket(f) for x in target for f in plain_features(x, ngram))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for at, (key, text) in enumerate(rows):
        found = plain_features(text, ngram)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets)
                                                / ((s[b] + 1.0) * (all_t + buckets))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(plain_words(text)), len(found), weight, score, None, at])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[6]))
    for place, r in enumerate(able[: share * len(able) // 100], 1):
        r[5] = place
    return [tuple(r[:6]) for r in out]


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("ngram,share,buckets", [(1, 10, 10_000), (3, 50, 97), (2, 100, 10_000)])
def test_draw_equals_the_plain_version(spark, ngram, share, buckets):
    rows = [(i * 7 % 11, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (3, TEXTS[4]), (3, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n_words": F.lit("own"), "weight": F.lit(1), "rank": F.lit(None).cast("string")}).repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = R.resample(docs, target, ngram=ngram, share=share, buckets=buckets)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert by_text(map(tuple, got.collect())) == by_text(
        plain(rows, TARGET, ngram, buckets, share))


@pytest.mark.parametrize("ngram", [1, 2, 4])
@pytest.mark.parametrize("limit", [1, 7, 64, 1 << 22])
def test_cut_and_joined_batches_have_the_features_of_whole_texts(ngram, limit):
    texts = [t.encode() if t is not None else None for t in TEXTS if not t or len(t) < 5000]
    want = Counter((row, zlib.crc32(f.encode())) for row, t in enumerate(texts)
                   for f in plain_features(t.decode() if t else t, ngram))
    got, words = Counter(), Counter()
    for word_rows, rows, crc in R.features(texts, ngram, limit):
        got.update(zip(rows.tolist(), crc.tolist()))
        words.update(word_rows.tolist())
    assert got == want
    assert words == Counter(r for r, t in enumerate(texts) for _ in plain_words(t.decode() if t else t))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert R.resample(empty, docs).collect() == []
    [row] = R.resample(docs, empty, share=100).collect()
    assert tuple(row) == plain([(1, "a " * 30)], [], share=100)[0] and row["rank"] == 1


def test_ranks_of_many_parts_and_hot_ties(spark):
    """A third of all rows are equal in every column: the ranks are 1, 2, 3 ... all the same."""
    rows = [(None, "tie " * 25)] * 400 + [(i, f"w{i % 9} " * 30) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("tie w3",)], "text string")
    got = R.resample(docs, target, share=60).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert len(got) == 1200 and ranks == list(range(1, 721))
    ordered = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["score"] for r in ordered] == sorted((r["score"] for r in ordered), reverse=True)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.TABLES_ORACLE["op11_importance_resampling"])
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == [c[0] for c in cur.description]
    assert by_text(map(tuple, got.collect())) == by_text(cur.fetchall())


def test_gains_follow_the_shares():
    gain = R.gains(np.array([99, 9, 0]), np.array([0, 9, 0]))
    assert gain[0] < gain[2] and gain[1] > 0
