"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; run()
writes it as Parquet to the cluster's shared folder and hands the reread table
to the next.  Every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.llm import langid, packing, quality, secrets, simhash
from cumulus.llm.common import small_batches, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# A text is in no learned language if its cosine is below LEAST_LANGUAGE times
# sqrt(n / (n + LANGUAGE_HALF)) for n characters.  The sum of n random n-gram vectors
# grows with sqrt(n), and what a text shares with its language's prototype with n, so
# its cosine rises like that and levels off; unrelated vectors have 0.03 by the spread,
# however long the text is.
LEAST_LANGUAGE, LANGUAGE_HALF = 0.15, 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the full policy rejects."""
    small_batches(spark)
    rows = quality.annotate(docs, "text", "__ledger")
    return rows.filter(quality.passes(quality.FULL, rows["__ledger.fail_bits"])).select(*[
        rows[f"`{c}`"] for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or like none go.

    Learns from the documents at hand whose crc32(doc_id) mod 3 is not 1.  With
    nothing to learn from, only texts without a letter go.
    """
    small_batches(spark)
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    prototypes = langid.learn(docs.filter(F.pmod(key, F.lit(3)) != 1))
    if not prototypes:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = docs.withColumn("__language", langid.predict("text", prototypes))
    n = F.length("text")
    least = LEAST_LANGUAGE * F.sqrt(n / (n + LANGUAGE_HALF))
    good = (F.col("__language.lang") != "und") & (F.col("__language.score") >= least)
    return found.filter(good).select(*[f"`{c}`" for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id."""
    small_batches(spark)
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by their kind in brackets."""
    small_batches(spark)
    done = docs.withColumn("__redacted", secrets.redacted("text"))
    new = {"text": F.col("__redacted.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.col("__redacted.n_chars").cast(docs.schema["n_chars"].dataType)
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in the sequences."""
    small_batches(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("packing", pack),
]

# Hashing, learned prototypes and tokenizer ids are beyond SQL; tests/llm holds
# the run against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs, f"pipeline/{i}_{name.replace(' ', '_')}")
    return docs
