"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text.  The ledger keeps the measurements and
one failure bit per rule; a policy is a named, versioned set of rules, applied
later to the stored bits.  Changing a threshold set therefore never re-reads
a text, and ablations (what would be kept without rule r) are bitwise
aggregation over the distinct bit patterns.

Built-in functions only.  Defined results: a null, empty or blank text has
zero words and fails ``few_words``; rows are independent, so repeated rows
and ids give repeated results; an empty table gives an empty ledger; other
columns, whatever their names, are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANKS, words, without

WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_upper")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements, true for a bad text."""
    name: str
    fails: str


# A rule's bit is its place in this list; new rules are appended, never moved.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 40 * n_words"),
    Rule("shouting", "2 * n_upper > word_chars"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bit = {r.name: 1 << i for i, r in enumerate(rules)}
        return sum(bit[n] for n in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
FULL = Policy("full", 1, tuple(r.name for r in RULES))

# Every version stays: bits stored long ago are judged by the policy of their time.
POLICIES = {(p.name, p.version): p for p in (
    BASE, FULL, Policy("web", 1, ("few_words", "repeated_windows", "repeated_lines", "symbols")),
    Policy("web", 2, ("few_words", "repeated_windows", "repeated_lines", "symbols", "long_words")))}


def policy(name: str, version: int | None = None) -> Policy:
    """The named policy of a version, or the newest."""
    found = {v: p for (n, v), p in POLICIES.items() if n == name}
    if not found or version is not None and version not in found:
        raise KeyError(f"no policy {name} {'' if version is None else version}; known are {sorted(POLICIES)}")
    return found[max(found) if version is None else version]


def annotate(df: DataFrame, text: str = "text", into: str = "ledger",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with one struct column more: the measurements and ``fail_bits``."""
    src = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    t = "__q_"
    df = df.withColumn(t + "w", words(src))
    # Hash of every run of WINDOW words, by its place.
    df = df.withColumn(t + "h", F.when(
        F.size(t + "w") > WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(t + "w") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice(t + "w", i, WINDOW)))))
    # Only texts with a repeated window pay for sorting theirs.
    df = df.withColumn(t + "s", F.when(
        F.size(F.array_distinct(t + "h")) < F.size(t + "h"),
        F.sort_array(F.transform(t + "h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter(t + "s", lambda e, j: F.coalesce(
        (F.get(t + "s", j - 1)["h"] == e["h"]), F.lit(False)) | F.coalesce(
        (F.get(t + "s", j + 1)["h"] == e["h"]), F.lit(False)))
    df = df.withColumn(t + "r", F.sort_array(F.transform(twice, lambda e: e["i"])))
    # A repeated window covers WINDOW words, or up to the next one's start.
    covered = F.aggregate(
        F.transform(t + "r", lambda i, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(t + "r", j + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    df = df.withColumn(t + "l", F.filter(
        F.split(src, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    symbols, upper = without(src, SYMBOLS), without(src, UPPER)
    values = {
        "n_words": F.size(t + "w"),
        "word_chars": F.length(without(src, BLANKS)),
        "n_symbols": F.length(src) - F.length(symbols),
        "n_lines": F.size(t + "l"),
        "n_dup_lines": F.size(t + "l") - F.size(F.array_distinct(t + "l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_upper": F.length(src) - F.length(upper),
    }
    df = df.withColumn(t + "m", F.struct(*[
        c.cast("long").alias(n) for n, c in values.items()]))
    bits = _bits(t + "m", rules)
    df = df.withColumn(t + "o", F.struct(
        *[F.col(f"{t}m.{n}").alias(n) for n in MEASURES], bits.alias("fail_bits")))
    df = df.drop(*[t + x for x in "whsrlm"])
    # explode() of one element is a fence: a filter on the ledger pushed below
    # it would put the whole calculation, many times over, into its condition.
    return df.select("*", F.explode(F.array(t + "o")).alias(into)).drop(t + "o")


def _bits(measures: str, rules: tuple[Rule, ...]) -> Column:
    def one(i: int, rule: Rule) -> Column:
        sql = rule.fails
        for n in MEASURES:
            sql = sql.replace(n, f"{measures}.{n}")
        return F.when(F.expr(sql), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return reduce(lambda a, b: a.bitwiseOR(b), [one(i, r) for i, r in enumerate(rules)])


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, the measurements, fail_bits: one row per row of ``df``."""
    return (annotate(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)),
                     text, "__ledger", rules).select(key, "__ledger.*"))


def passes(policy: Policy, bits: Column | str = "fail_bits",
           rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the policy failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablations(ledger: DataFrame, policies: tuple[Policy, ...] = (BASE, FULL),
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule of it: rows kept, rows kept without the rule, and rows
    that this rule alone rejects.  The rows are first counted by bit pattern
    (at most 2^rules of them), so the rest runs on a handful of rows."""
    patterns = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                      F.lit(r.name).alias("rule"),
                      F.lit(p.mask(rules)).cast("long").alias("mask"),
                      F.lit(1 << i).cast("long").alias("bit"))
             for p in policies for i, r in enumerate(rules) if r.name in p.rules]
    each = patterns.select("fail_bits", "n", F.inline(F.array(*cases)))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (each.groupBy("policy", "version", "rule")
            .agg(F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"),
                 F.sum(F.when(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n"))
                       .otherwise(0)).alias("n_kept_without"),
                 F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0))
                 .alias("n_only_this")))
