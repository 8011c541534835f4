"""The pipeline on the small tables, each stage held against a plain version."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as P
from cumulus.llm import secrets
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


def plain_kept(text):
    """The full quality policy, written out."""
    words = [w for w in _split(text or "") if w]
    lines = [x for x in (text or "").split("\n") if any(_split(x))]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else ()
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    chars = sum(map(len, words))
    upper = sum("A" <= c <= "Z" for c in text or "")
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return not (len(words) < 20 or 100 * len(covered) > 30 * len(words)
                or 10 * symbols > len(words) or 2 * (len(lines) - len(set(lines))) > len(lines)
                or chars < 2 * len(words) or chars > 40 * len(words) or 2 * upper > chars)


def _split(text):
    out = [""]
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            out.append("")
        else:
            out[-1] += c
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("ledger", F.lit("own"))
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = P.stored(stage(spark, docs, SF), "test_stage")
        assert out.columns == docs.columns
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "quality rules":
            assert set(after) == {k for k, r in before.items() if plain_kept(r["text"])}
        elif name == "language ID":
            assert set(after) == set(before)  # all are sentences of the four languages
        elif name == "SimHash near-dedup":
            least = plain_components([(k, r["text"]) for k, r in before.items()])
            assert set(after) == {least[plain_fingerprint(r["text"])] for r in before.values()}
        else:
            assert set(after) == set(before)
            for k, r in after.items():
                assert r["text"] == secrets.redact(before[k]["text"])
                assert r["n_chars"] == len(r["text"]) and not secrets.findings(r["text"])[1]
        docs, before = out, after
    rows = P.STAGES[-1][1](spark, docs, SF).collect()
    check(rows, [(k, r["text"]) for k, r in before.items()], 2048)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, Ledger string"
    good = ("the quick brown fox jumps over a lazy dog while all other dogs sleep in the warm "
            "sun near the old mill by the river")
    rows = [(1, None, "en", "s", None, "a"), (2, "", None, None, 0, None), (3, good, "en", "s", 9, "b"),
            (3, good, "en", "s", 9, "b"), (None, good, "en", "s", 9, "b"), (5, good + " end", "en", "s", 9, "c")]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in P.STAGES[:4]:
        docs = P.stored(stage(spark, docs, SF), "test_stage")
    got = [tuple(r) for r in docs.collect()]
    assert [r[0] for r in got if r[1] == good] == [3]
    empty = spark.createDataFrame([], schema)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_language_stage_rejects_noise(spark):
    import random
    rng = random.Random(5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    noise = [(10**9 + i, "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(200)), None, None, 1)
             for i in range(5)] + [(2 * 10**9, "123 456 789", None, None, 1)]
    out = P.language_id(spark, docs.union(spark.createDataFrame(noise, docs.schema)), SF)
    ids = {r[0] for r in out.select("doc_id").collect()}
    assert ids == {r[0] for r in docs.select("doc_id").collect()}


def test_language_threshold_grows_smoothly():
    """No jump at any length: neighbouring lengths differ by little."""
    least = [P.LEAST_LANGUAGE * (n / (n + P.LANGUAGE_HALF)) ** 0.5 for n in range(1, 5000)]
    assert all(0 < b - a < 0.01 for a, b in zip(least, least[1:])) and least[-1] < P.LEAST_LANGUAGE


def test_redacted_texts_hold_no_plain_secret(spark):
    """Against the contract's patterns written out, not against the scan itself."""
    from tests.llm.test_secrets import plain_base
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in P.secret_scans(spark, docs, SF).collect()}
    dirty = {k for k, t in before.items() if plain_base(t or "")}
    assert dirty and not [k for k, t in after.items() if plain_base(t or "")]
    for k, t in before.items():
        if k in dirty:      # the text outside its spans is as it was
            assert after[k] != t and after[k].split("[")[0] == t[:len(after[k].split("[")[0])]
        else:
            assert after[k] == t or len(after[k]) < len(t)


def test_run_is_registered(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run
    assert public_tokenizers.path("byte_bpe_50k.json") == P.TOKENIZER
    assert P.run(spark, "/root/testdata/sf0.001").count() > 100
