"""Packing: ids equal the tokenizer's, pieces cover them, windows are tight."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cumulus.llm import packing as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["one two three", None, "", "word " * 3000, "a" * 9000, "<|endoftext|> x", "ÄÖ 你好 🎉 \r\n\t",
         "it's 12,345 & more", "one two three"]


def plain_best_fit(lengths, window):
    rooms, out = [], []
    for n in lengths:
        fit = [(r, -i) for i, r in enumerate(rooms) if r >= n]
        if not fit:
            rooms.append(window)
            fit = [(window, -(len(rooms) - 1))]
        room, i = min(fit)
        out.append(room)
        rooms[-i] -= n
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_window(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 40) for _ in range(300)), reverse=True)
    got = K.best_fit(lengths, 40)
    assert [40 - o for _, o in got] == plain_best_fit(lengths, 40)
    ends = {}
    for (s, o), n in zip(got, lengths):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert max(ends.values()) <= 40


def check(rows, docs, window):
    tk, by_doc, by_seq = Tokenizer.from_file(PATH), {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, text in docs:
        ids = tk.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= window


@pytest.mark.parametrize("bin_pieces", [K.BIN, 4])
def test_pieces_cover_every_document(spark, bin_pieces):
    docs = list(enumerate(TEXTS))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("x"))
    check(K.pack(df, PATH, bin_pieces=bin_pieces).collect(), docs, K.WINDOW)
    check(K.pack(df, PATH, window=7).collect(), docs, 7)


def test_ids_come_along_when_asked(spark):
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    r = K.pack(df, PATH, with_ids=True).first()
    assert np.frombuffer(r["ids"], "<u4").tolist() == \
        Tokenizer.from_file(PATH).encode("one two").ids + [1]


def test_empty_null_and_repeated_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert K.pack(df, PATH).count() == 0
    big = 2**60 + 1
    df = spark.createDataFrame([(None, "a b"), (big, "c"), (big, "c")], "doc_id long, text string")
    rows = K.pack(df.coalesce(1), PATH).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == [str(big), str(big), "None"]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


def test_real_documents_with_little_padding(spark):
    from cumulus.llm.queries import op7_packing
    sf = "/root/testdata/sf0.01"
    rows = op7_packing(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").collect()]
    check(rows, docs, K.WINDOW)
    used = sum(r["length"] for r in rows)
    assert used / (K.WINDOW * len({r["sequence_id"] for r in rows})) > 0.98
