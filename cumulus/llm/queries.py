"""The registered queries of the text operators, and SQL for those that SQL can say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (audit, decontaminate, embeddings, html, katz, langid, licenses, oracles, packing,
               quality, resample, secrets, sentencepiece, simhash)
from .common import stored, table


def _remainder(key: str, divisor: int):
    """crc32 of the key as text, by its remainder; a null key counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(divisor))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return (pages.select("page_id", "url", html.extracted("html").alias("e"))
            .select("page_id", "url", "e.text", "e.n_chars"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label."""
    return embeddings.near_duplicates(
        table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return sentencepiece.encode(table(spark, sf_dir, "documents", "doc_id", "text"), PIECES,
                                check=True)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn(
        "held_out", _remainder("doc_id", 3) == 1)
    prototypes = langid.learn(docs.filter("NOT held_out"))
    return (docs.select("doc_id", "held_out", langid.predict("text", prototypes).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score")))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality ledger of all documents, written once."""
    return stored(quality.ledger(table(spark, sf_dir, "documents", "doc_id", "text")), "quality_ledger")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document, with the verdict of the full policy, from the stored
    bits; what each rule rejects is stored beside it as ``quality_ablations``."""
    rows = _ledger(spark, sf_dir)
    stored(quality.ablations(rows), "quality_ablations")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", (~quality.passes(quality.BASE)).alias("base_failed"),
                       quality.passes(quality.FULL).alias("kept"), "fail_bits")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every policy, version and rule: documents kept, kept without the rule, and
    rejected by it alone, from the stored bits."""
    return quality.ablations(_ledger(spark, sf_dir), tuple(quality.POLICIES.values()))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, those in nested encodings included."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = docs.select("doc_id", secrets.scanned("text").alias("f")).select("doc_id", "f.*")

    def count(kind: str):
        return F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in secrets.KINDS],
                        F.sha2("base", 256).alias("base_sha256"), "spans", "oversized")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document's tokens lies in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_BPE)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document by a model of those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = katz.train(docs.filter(_remainder("doc_id", 7) != 2))
    return katz.score(docs, model).select(
        "doc_id", (_remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and labels of the licenses named or quoted in every document."""
    return licenses.summary(licenses.licenses(table(spark, sf_dir, "documents", "doc_id", "text")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in the draw towards the benchmark texts."""
    return resample.resample(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"),
    ).select("doc_id", "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside verbatim copies of benchmark windows, and whose."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                        table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every filter removes at every step of every order, by source."""
    return audit.audit(audit.masks(
        table(spark, sf_dir, "documents", "doc_id", "text", "source"),
        table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "quality_ablations": quality_ablations,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_license_scan": op10_license_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
}

_BLANK = r"[\x20\x09-\x0D]+"

_LEDGER = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t,
         list_filter(regexp_split_to_array(t, '{_BLANK}'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_replace(x, '{_BLANK}', '', 'g') <> '') AS ls
  FROM d),
g AS (
  SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS gram
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g),
p AS (
  SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS k
  FROM c WHERE n > 1),
x AS (SELECT r, sum(k) AS n_repeat_words FROM p GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '{_BLANK}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN x USING (r)),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END) AS bits
  FROM m)
"""

_CASES = ", ".join(
    f"('{p.name}', {p.version}, '{r.name}', {p.mask()}, {1 << i})" for p in quality.POLICIES.values()
    for i, r in enumerate(quality.RULES) if r.name in p.rules)

ORACLE = {
    "op8_quality_rules": _LEDGER + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS fail_bits
FROM b""",
    "quality_ablations": _LEDGER + f"""
SELECT policy, version, rule, count(*) FILTER (bits & mask = 0) AS n_kept,
       count(*) FILTER (bits & mask & ~bit = 0) AS n_kept_without,
       count(*) FILTER (bits & mask = bit) AS n_only_this
FROM b, (VALUES {_CASES}) AS c(policy, version, rule, mask, bit) GROUP BY policy, version, rule""",
}

# SQL that reads other tables than documents.
TABLES_ORACLE = {
    "op11_importance_resampling": oracles.RESAMPLING,
    "op12_decontamination": oracles.DECONTAMINATION,
    "op13_filter_audit": oracles.FILTER_AUDIT,
}
