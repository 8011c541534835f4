"""SentencePiece: streamed ids against Viterbi over the whole text, round trips."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from cumulus.llm import sentencepiece as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the house", "", "  two  spaces ", "\n\ttabs\n", "Ünïcode 你好 🎉‍ x", "a" * 500, "12,345.67",
         "▁sign", "no break", "\x00\x07", "internationalization of houses\nand more", " "]


def plain(model, text):
    """Viterbi over the whole text at once."""
    text = S.SPACE + text.replace(" ", S.SPACE) if text else ""
    best = [(0.0, None, ())]
    for j in range(1, len(text) + 1):
        found = []
        for i in range(max(0, j - model.longest), j):
            if (p := model.pieces.get(text[i:j])) is not None:
                found.append((best[i][0] + p[1], -i, (p[0],)))
            elif i == j - 1:
                found.append((best[i][0] + model.unknown, -i, model.unknown_ids(text[i:j])))
        score, i, ids = max(found, key=lambda f: f[:2])
        best.append((score, -i, ids))
    out, j = [], len(text)
    while j:
        out.append(best[j][2])
        j = best[j][1]
    return [i for ids in reversed(out) for i in ids]


def test_ids_equal_whole_text_viterbi_and_round_trip():
    model, sp = S.Model(PATH), SentencePieceProcessor(model_file=PATH)
    for t in TEXTS:
        ids = model.encode(t)
        assert ids.tolist() == plain(model, t), t
        assert model.decode(ids) == t.replace(S.SPACE, " ") == sp.decode(ids.tolist())


@pytest.mark.parametrize("seed", range(8))
def test_ambiguous_models(seed):
    """Random pieces over two letters, spaces inside pieces too; whole scores, as in
    the model file, so that equal sums are equal."""
    rng, model = random.Random(seed), S.Model(PATH)
    letters = "ab" + S.SPACE * (seed % 2)
    pieces = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(25)}
    model.set({p: (1000 + i, -float(rng.randint(1, 12))) for i, p in enumerate(sorted(pieces))})
    for n in (1, 7, 300):
        text = "".join(rng.choice("ab ") for _ in range(n))
        assert model.encode(text).tolist() == plain(model, text)


def test_ids_are_given_out_early():
    model = S.Model(PATH)
    asked = 0

    def source():
        nonlocal asked
        for c in "▁house" * 200:
            asked += 1
            yield c

    first = next(model.stream(source()))
    assert first and asked <= S.EVERY + 2 * model.longest


def test_every_id_of_a_text_comes_from_the_stream(monkeypatch):
    model, streamed = S.Model(PATH), []
    stream = S.Model.stream

    def watched(self, chars):
        for ids in stream(self, chars):
            streamed.extend(ids)
            yield ids
    monkeypatch.setattr(S.Model, "stream", watched)
    texts = TEXTS + ["unrepeated", "x" * 2000, "mixedCASE" * 30]
    for t in texts:
        streamed.clear()
        model.known.clear()
        model.older.clear()
        # Parts that come again in a text are remembered, so each text's are new here.
        ids = model.encode(t).tolist()
        assert set(ids) == set(streamed) and len(streamed) <= len(ids)


def test_the_window_stays_as_wide_as_the_longest_piece():
    """A model whose paths part for good: ids wait, scores do not pile up."""
    model = S.Model(PATH)
    model.set({"a": (1, -3.0), "aa": (2, -6.0), "aaa": (3, -9.5)})
    cost = {1: -3.0, 2: -6.0, 3: -9.5}
    for n in (1, 2, 3, 4, 1000):
        got = [i for ids in model.stream(iter("a" * n)) for i in ids]
        assert sum(got) == n and sum(cost[i] for i in got) == -3.0 * n


def test_frame(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(90, None), (0, TEXTS[0]), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("a"))
    out = S.encode(df, PATH, check=True)
    model = S.load(PATH)
    assert all(r["round_trip"] for r in out.collect())
    want = sorted((str(k), model.encode(t).tolist()) for k, t in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in out.collect()) == want
    back = sorted((str(r["doc_id"]), r["text"]) for r in S.decode(out, PATH).collect())
    assert back == sorted((str(k), (t or "").replace(S.SPACE, " ")) for k, t in rows)
    assert S.encode(df.limit(0), PATH).count() == S.decode(out.limit(0), PATH).count() == 0


def test_documents(spark):
    from cumulus.llm.queries import op3_sentencepiece
    sf = "/root/testdata/sf0.001"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    model = S.load(PATH)
    got = op3_sentencepiece(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["round_trip"] and r["n_ids"] == len(r["ids"])
        if len(docs[r["doc_id"]]) < 3000:
            assert r["ids"] == plain(model, docs[r["doc_id"]])
