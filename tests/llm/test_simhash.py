"""SimHash groups against all pairs compared in plain Python."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cumulus.llm import simhash as S


def plain_fingerprint(text, k=4):
    out, word = [], b""
    for c in (text or "").encode():
        c = c + 32 if 65 <= c <= 90 else c
        if c == 32 or 9 <= c <= 13:
            out, word = out + [word] * bool(word), b""
        else:
            word += bytes([c])
    out += [word] * bool(word)
    if not out:
        return 0
    grams = [b" ".join(out[i:i + k]) for i in range(max(1, len(out) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, distance=4):
    fps = {}
    for key, text in rows:
        fps.setdefault(plain_fingerprint(text), []).append(key)
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    each = list(fps)
    for i, x in enumerate(each):
        for y in each[:i]:
            if (x ^ y).bit_count() <= distance:
                label[root(x)] = root(y)
    groups = {}
    for f, keys in fps.items():
        groups.setdefault(root(f), []).extend(k for k in keys if k is not None)
    return {f: min(groups[root(f)], default=None) for f in fps}


def corpus(n=120, seed=3):
    rng, words = random.Random(seed), [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 300))]
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.choice((0, 0, 1, 6))):
            copy = list(text)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " \n".join(copy).upper()))
    rng.shuffle(rows)
    return rows + [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "one two"), (9004, "One  two"),
                   (rows[0][0], rows[0][1]), (None, rows[1][1]), (None, "alone in here all day"),
                   (9005, "ÄÖ äö x   y")]


def signed(f):
    return f - (1 << 64) if f >= 1 << 63 else f


@pytest.mark.parametrize("block", [S.BLOCK, 3])
def test_components_equal_brute_force(spark, block):
    rows = corpus()
    want = plain_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = S.near_duplicates(df, block=block).collect()
    assert len(got) == len(rows)
    texts = {}
    for key, text in rows:
        texts.setdefault(key, set()).add(signed(plain_fingerprint(text)))
    by_fp = {signed(f): c for f, c in want.items()}
    for r in got:
        assert r["fp"] in texts[r["doc_id"]]
        assert r["component"] == by_fp[r["fp"]]


def test_one_row_of_each_component_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "a") for r in rows + rows[:9]],
                               "doc_id long, text string, text_hash string")
    kept = S.keep_one(df).collect()
    want = plain_components(rows)
    assert len(kept) == len(set(want[plain_fingerprint(t)] if want[plain_fingerprint(t)] is not None
                                else ("none", plain_fingerprint(t)) for _, t in rows))
    assert all(r["doc_id"] == want[plain_fingerprint(r["text"])] for r in kept)
    assert kept[0].asDict().keys() == {"doc_id", "text", "text_hash"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.keep_one(df).count() == 0


def test_thresholds_keep_the_pigeonhole_sum():
    rng = random.Random(1)
    values = S.np.array([signed(rng.getrandbits(64)) for _ in range(200)])
    parts = S.partition_bits(values)
    assert sorted(b for p in parts for b in p) == list(range(64))
    for rows in (10, 10**4, 10**8):
        t = S.thresholds(values, rows, parts)
        assert sum(x + 1 for x in t) == S.DISTANCE + 1 and min(t) >= -1


def test_more_fingerprints_ask_for_wider_partitions():
    rng = random.Random(1)
    values = S.np.array([signed(rng.getrandbits(64)) for _ in range(1000)])
    sizes = []
    for rows in (10**4, 10**7, 10**10):
        parts, t = S.plan(values, rows)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert len(t) == len(parts) and sum(x + 1 for x in t) == S.DISTANCE + 1
        sizes.append(len(parts))
    assert sizes == [4, 3, 2]


@pytest.mark.parametrize("parts", S.PARTS)
def test_links_do_not_depend_on_the_partitions(spark, parts):
    fps = sorted({plain_fingerprint(t) for _, t in corpus(40)})
    # Up to six bits changed: some links lie at the distance itself, some beyond it.
    rng = random.Random(parts)
    fps = sorted({f ^ sum(1 << b for b in rng.sample(range(64), n)) for f in fps for n in range(7)})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    near = [(f, g) for f in fps for g in fps if f < g and (f ^ g).bit_count() <= S.DISTANCE]
    for f, g in near:
        root[find(f)] = find(g)
    want = {frozenset(signed(g) for g in fps if find(g) == r) for r in map(find, fps)}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = S.links(df, choice=(parts,)).collect()
    root = {signed(f): signed(f) for f in fps}
    for r in got:
        root[find(r["a"])] = find(r["b"])
    assert {frozenset(g for g in root if find(g) == r) for r in map(find, root)} == want


def test_fingerprint_of_long_text_in_chunks(monkeypatch):
    text = " ".join(f"v{i % 97}" for i in range(5000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "CHUNK", 100)
    assert S.fingerprint(text) == whole == signed(plain_fingerprint(text))


def test_query_equals_brute_force(spark):
    from cumulus.llm.queries import op4_simhash
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_components(docs)
    got = op4_simhash(spark, sf)
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(docs)
    for key, text in docs:
        fp = plain_fingerprint(text)
        assert (rows[key]["fingerprint"], rows[key]["component_id"]) == (f"{fp:016x}", want[fp])
