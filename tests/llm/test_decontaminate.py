"""Decontamination against word-by-word search: hits, spans, longest matches, items."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import decontaminate as D, queries
from tests.llm.test_resample import plain_words

SF = "/root/testdata/sf0.001"
ITEM = "It was the best of times it was the worst of times it was the age of wisdom"
ITEMS = [("a", ITEM), ("b", None), ("c", ""), ("d", "three short words"), (None, "loose"),
         ("e", ITEM.upper() + " it was the age of foolishness"), ("a", "another text of the item a " * 3),
         ("z", "x x x x x x x x x x x x")]
TEXTS = [None, "", "...", "nothing of it here", ITEM, "he said: " + ITEM + ". And then " + ITEM + "!",
         " ".join(ITEM.split()[:9]), " ".join(ITEM.split()[3:13]), "so three; SHORT\nwords, three short",
         "loose", "x " * 30, ITEM.replace("worst", "worse"), "Ünï " + ITEM.replace(" ", "\x00 ") + "ü",
         "y " * 4000 + ITEM + " y" * 4000, "the " * 500, ITEM, ITEM]


def plain(text, items, window):
    """(n_words, n_hit, longest, spans, items) by comparing at every place."""
    words, hit, names, longest = plain_words(text), set(), set(), 0
    for name, item in items:
        own = plain_words(item)
        w = min(window, len(own))
        for j in range(len(own) - w + 1 if own else 0):
            for i in range(len(words) - w + 1):
                if words[i:i + w] == own[j:j + w]:
                    hit.update(range(i, i + w))
                    names.add("" if name is None else str(name))
    for i in range(len(words)):      # longest match from any place where a window begins
        for name, item in items:
            own = plain_words(item)
            w = min(window, len(own))
            for j in range(len(own) - w + 1 if own else 0):
                if words[i:i + w] == own[j:j + w]:
                    for _, other in items:
                        o = plain_words(other)
                        for k in range(len(o)):
                            n = 0
                            while i + n < len(words) and k + n < len(o) and words[i + n] == o[k + n]:
                                n += 1
                            longest = max(longest, n)
                    break
            else:
                continue
            break
    spans = []
    for p in sorted(hit):
        if spans and spans[-1][1] == p:
            spans[-1][1] = p + 1
        else:
            spans.append([p, p + 1])
    return len(words), len(hit), longest, spans, sorted(names)


def result(row):
    return (row["n_words"], row["n_hit"], row["longest"], [[s["start"], s["end"]] for s in row["spans"]],
            list(row["items"]))


@pytest.mark.parametrize("window", [1, 3, 10])
@pytest.mark.parametrize("chunk", [1, 120, 1 << 20])
def test_contamination_equals_the_plain_version(spark, window, chunk):
    rows = list(enumerate(TEXTS)) + [(4, ITEM), (4, ITEM), (None, ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n_hit": F.lit("own"), "items": F.lit(1), "item_id": F.lit(2)}).repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    short = {t: plain(t, ITEMS, window) for t in TEXTS if not t or len(t) < 5000}
    got = D.contamination(docs, items, window=window, chunk=chunk).collect()
    assert len(got) == len(rows)
    for r in got:
        text = ITEM if r["doc_id"] is None else TEXTS[r["doc_id"]]
        if text in short:
            assert result(r) == short[text], text
        else:
            n = len(ITEM.split())
            assert r["n_words"] == 8000 + n and r["longest"] == n
            assert (4000, 4000 + n) in [tuple(s) for s in r["spans"]] or window == 1
    kept = D.clean(docs, items, window=window, chunk=chunk)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted(
        (i is None, i) for i, t in rows if t in short and not short[t][1])


@pytest.mark.parametrize("shard", [1, 3, 25, 10_000])
def test_texts_cut_over_shards(shard):
    rng = random.Random(shard)
    items = [(str(i), " ".join(rng.choices("abc", k=rng.randint(1, 14)))) for i in range(6)]
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(12)] + [None]
    chunk = D.Chunk.of([(n, t.encode()) for n, t in items], 4)
    got = D._scan([t.encode() if t is not None else None for t in texts], chunk, shard)
    assert [result(r) for r in got] == [plain(t, items, 4) for t in texts]


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(3)
    for depth in (1, 2, 7, 40):
        ids = rng.integers(0, 4, 200).astype(np.int32)
        order, rank = D.suffix_array(ids, depth)

        def suffix(i):
            s = ids[i:i + depth].tolist()
            return s[: s.index(0)] if 0 in s else s
        assert sorted(order.tolist()) == np.flatnonzero(ids).tolist()
        listed = [suffix(i) for i in order]
        assert listed == sorted(listed)
        assert all(suffix(a) == suffix(b) for a in order for b in order if rank[a] == rank[b])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert D.contamination(empty, items).collect() == []
    [row] = D.contamination(docs, items.limit(0)).collect()
    assert result(row) == (18, 0, 0, [], []) and D.clean(docs, items.limit(0)).count() == 1


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.TABLES_ORACLE["op12_decontamination"])
    got = queries.op12_decontamination(spark, SF)
    assert got.columns == [c[0] for c in cur.description]
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())
    assert got.filter("contaminated").count() > 0
