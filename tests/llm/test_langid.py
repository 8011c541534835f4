"""Language ID: held-out accuracy, agreement with a plain version, odd inputs."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from cumulus.llm import langid as L

TEXT = {"en": "the quick brown fox jumps over the lazy dog while the other dogs are sleeping",
        "de": "der schnelle braune fuchs springt über den faulen hund und die anderen schlafen",
        "fr": "le renard brun rapide saute par dessus le chien paresseux et les autres dorment"}


def plain_vector(text):
    """The same bundle, one n-gram after the other."""
    low = "".join(c.lower() if c.isalpha() else " " for c in text)
    low = " " + " ".join(low.split()) + " "
    space, out = L.Space(), np.zeros(L.DIM)
    for i in range(len(low) - 2):
        parts = [np.roll(space.letter(0 if c == " " else ord(c)), 2 - j)
                 for j, c in enumerate(low[i:i + 3])]
        out += parts[0].astype(int) * parts[1] * parts[2]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_predictions_equal_plain_version(spark):
    df = frame(spark, [(i, t, k) for i, (k, t) in enumerate(TEXT.items())])
    protos = L.learn(df)
    for k, t in TEXT.items():
        assert (protos[k] == plain_vector(t)).all()
    asks = ["the dogs", "die hunde", "LES chiens!", "x", "Ж"]
    got = (frame(spark, [(i, t, None) for i, t in enumerate(asks)])
           .select("text", L.predict("text", protos).alias("p")).collect())
    for r in got:
        v = plain_vector(r["text"])
        cos = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in protos.items()}
        assert r["p"]["lang"] == max(cos, key=cos.get)
        assert abs(r["p"]["score"] - max(0, max(cos.values()))) < 1e-5


def test_odd_texts(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 345 !?", "de"), (4, TEXT["en"], None),
            (5, TEXT["de"], "de"), (5, TEXT["de"], "de"), (6, "ab" * 200_000, "xx")]
    df = frame(spark, rows).withColumn("score", F.lit(1)).withColumn("gram", F.lit("a"))
    protos = L.learn(df)
    assert list(protos) == ["de", "xx"]
    got = {r["doc_id"]: r["p"] for r in df.select("doc_id", L.predict("text", protos)
                                                  .alias("p")).collect()}
    assert [got[i]["lang"] for i in (1, 2, 3, 5, 6)] == ["und", "und", "und", "de", "xx"]
    assert got[1]["score"] == got[3]["score"] == 0 and got[5]["score"] > 0.99


def test_nothing_to_learn(spark):
    df = frame(spark, [])
    assert L.learn(df) == {}
    got = frame(spark, [(1, "some text", None)]).select(L.predict("text", {}).alias("p")).first()
    assert tuple(got["p"]) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from cumulus.llm.queries import op5_language_id
    got = op5_language_id(spark, "/root/testdata/sf0.01").join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    out = [r for r in got if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
