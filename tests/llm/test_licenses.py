"""License scans against a word-by-word search and against edited notices."""

from pyspark.sql import functions as F

from cumulus.llm import licenses as L

SF = "/root/testdata/sf0.01"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
        "mit license": "mit"}


def plain_words(text):
    out = [""]
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) >= 128 or "0" <= c <= "9" or "a" <= c <= "z":
            out[-1] += c
        else:
            out.append("")
    return [w for w in out if w]


def plain_base(text):
    ws = plain_words(text)
    at = [(i, label) for phrase, label in BASE.items() for i in range(len(ws))
          if ws[i:i + len(phrase.split())] == phrase.split()]
    return (len(ws), len(at), min((i for i, _ in at), default=None),
            max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("w", F.lit(1)) \
        .withColumn("key", F.lit(2)).withColumn("hash", F.lit(3))
    return L.summary(L.licenses(df)).collect()


def row(r):
    return tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


def test_base_places(spark):
    texts = ["", None, "mit", "MIT License", "mit-license cc-by CC BY-NC 4.0", "mıt license",
             "the GNU General Public\nLicense v3 gnu general public license", "apache  license " * 50,
             "gnu general public licence", "!!!", "é cc by", "mit license mit license mit"]
    rows = list(enumerate(texts)) + [(3, "MIT License"), (3, "cc by"), (None, "cc by")]
    got = run(spark, rows)
    assert sorted((str(r["doc_id"]), *map(str, row(r))) for r in got) == \
        sorted((str(k), *map(str, plain_base(t))) for k, t in rows)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["labels"] == "cc-by,cc-by-nc,mit" and by[4]["score"] == 1
    assert by[8]["labels"] == "" and by[8]["score"] == 0


def test_edited_notice_is_one_verified_span(spark):
    notice = L.TEMPLATES[[t.label for t in L.TEMPLATES].index("mit-text")].text
    ws = notice.split()
    edited = " ".join(ws[:20] + ["really", "quite"] + ws[22:50] + ws[53:])
    half = " ".join(ws[:25])
    got = {r["doc_id"]: r for r in run(spark, [
        (1, f"x y z {notice}"), (2, edited), (3, half), (4, " ".join(sorted(ws)))])}
    assert got[1]["labels"] == got[2]["labels"] == "mit-text"
    assert got[1]["score"] == 1 and 0.8 < got[2]["score"] < 1
    assert got[3]["labels"] == got[4]["labels"] == "" and got[1]["n_base"] == 0
    df = spark.createDataFrame([(1, f"x y z {notice} tail"), (2, edited)], "doc_id long, text string")
    found = {r["doc_id"]: r["found"] for r in L.licenses(df).collect()}
    n = len(plain_words(notice))
    assert [(s["first"], s["last"]) for s in found[1]] == [(3, n + 2)]
    assert len(found[2]) == 1 and found[2][0]["first"] == 0


def test_numbered_notice_with_a_repeated_clause(spark):
    notice = L.TEMPLATES[[t.label for t in L.TEMPLATES].index("bsd-text")].text
    numbered = notice.replace("Redistributions of", "1. Redistributions of").replace(
        "Redistributions in", "2. Redistributions in")
    twice = f"{numbered} {'some other words ' * 40} {notice}"
    df = spark.createDataFrame([(1, f"a b {numbered} c"), (2, twice)], "doc_id long, text string")
    found = {r["doc_id"]: r["found"] for r in L.licenses(df).collect()}
    n = len(plain_words(notice))
    assert [(s["first"], s["last"], s["cover"]) for s in found[1]] == [(2, n + 3, 1.0)]
    assert sorted((s["first"], s["last"]) for s in found[2]) == [(0, n + 1), (n + 122, 2 * n + 121)]
    assert [r["labels"] for r in run(spark, [(1, numbered)])] == ["bsd-text"]


def test_names_and_identifiers_in_use(spark):
    want = {"SPDX-License-Identifier: MIT": "mit", "BSD 3-Clause License": "bsd-3-clause", "under GPLv3.": "gpl",
            "GNU GPL v2": "gpl", "CC0 1.0": "cc0", "The Unlicense": "unlicense",
            "Boost Software License - Version 1.0": "boost", "SPDX-License-Identifier: BSD-2-Clause": "bsd-2-clause",
            "spdx license identifier apache 2.0": "apache", "SPDX-License-Identifier: Frob-1.0": "",
            "bsd 4 clause": "", "mit": "", "boost license": ""}
    got = {r["doc_id"]: r["labels"] for r in run(spark, list(enumerate(want)))}
    assert [got[i] for i in range(len(want))] == list(want.values())


def test_notices_of_every_label_are_found(spark):
    notices = [t for t in L.TEMPLATES if not t.exact]
    got = {r["doc_id"]: r for r in run(spark, [(i, f"Copyright me. {t.text}") for i, t in enumerate(notices)])}
    for i, t in enumerate(notices):
        assert t.label in got[i]["labels"].split(",") and got[i]["score"] == 1, t.label
    assert len({t.label for t in L.TEMPLATES}) > 25


def test_whole_texts_from_files(spark, tmp_path):
    text = " ".join(f"clause{i} binds party{i * 7} in case {i * 3}" for i in range(60))
    (tmp_path / "own").write_text(text)
    templates = L.read_templates({"own": str(tmp_path / "own")})
    df = spark.createDataFrame([(1, f"x {text} y"), (2, text[:200])], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in L.summary(L.licenses(df, templates=templates),
                                                        templates=templates).collect()}
    assert got == {1: "own", 2: ""}


def test_no_text_is_shuffled(spark):
    """Also where no join may be broadcast from its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = spark.createDataFrame([(i, f"mit license {i}") for i in range(9)], "doc_id long, body string")
        out = L.licenses(df, text="body")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "body" not in plan and "Exchange" in plan and "runs" not in plan.partition("Exchange")[0]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_documents(spark):
    from cumulus.llm.queries import op10_license_scan
    docs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = op10_license_scan(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert row(r) == plain_base(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
