"""Quality rules: a ledger of failure bits and measurements, and policies over the bits.

Every rule is evaluated once for each document. The ledger keeps what was measured and one bit
for each rule that failed, so that a policy is a mask, a new policy needs no text, and the effect
of leaving a rule out of a policy is a count over distinct bit patterns.

Only built-in functions work here; nothing of a text leaves its row. Windows of five words are
compared by a 64-bit hash of the five words within one document.

Nulls and odd rows: a null or blank text has no words and fails ``few_words`` alone. Repeated
rows are judged one by one. Extra columns are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .inputs import BLANKS, texts, words

WINDOW = 5


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in a window of five words that occurs twice or more. Each
    step is a column of its own, since a lambda evaluates what it names for every element."""
    held, hashes, placed, starts = (F.col(c) for c in ("held", "_hashes", "_placed", "_starts"))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(F.get(placed, a)["h"] == F.get(placed, b)["h"], F.lit(False))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(held) - WINDOW),
        lambda i: F.xxhash64(*(held[i + k] for k in range(WINDOW))),
    )
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    by_hash = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    again = F.filter(placed, lambda x, k: same(k, k - 1) | same(k, k + 1))
    # A start covers five words, or as many as there are up to the next start.
    covers = F.transform(
        starts, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - i, F.lit(WINDOW)))
    )
    total = F.aggregate(covers, F.lit(0), lambda n, x: n + x)
    return (
        rows.withColumn("_hashes", F.when(F.size(held) > WINDOW, windows))
        .withColumn("_placed", F.when(repeats, F.sort_array(by_hash)))
        .withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
        .drop("_hashes", "_placed", "_starts")
    )


def measurements(docs: DataFrame) -> DataFrame:
    """A row per document with what the rules look at."""
    text = F.col("text")
    split = texts(docs).select(
        "doc_id",
        words(text).alias("held"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    return _with_repeat_words(split).select(
        "doc_id",
        F.size("held").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        "n_capitals",
    )


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements, in whole numbers. The bit never changes."""

    name: str
    bit: int
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = {
    rule.name: rule
    for rule in (
        Rule("few_words", 0, "n_words < 10"),
        Rule("repeated_windows", 1, "100 * n_repeat_words > 20 * n_words"),
        Rule("symbols", 2, "100 * n_symbols > 10 * n_words"),
        Rule("short_words", 3, "n_words > 0 and word_chars < 2 * n_words"),
        Rule("long_words", 4, "word_chars > 15 * n_words"),
        Rule("repeated_lines", 5, "100 * n_dup_lines > 50 * n_lines"),
        Rule("capitals", 6, "100 * n_capitals > 30 * word_chars"),
    )
}

#: Policies by version: the rules that reject. A version is never changed, only followed.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: tuple(RULES),
}


def policy_mask(version: int) -> int:
    return sum(RULES[name].mask for name in POLICIES[version])


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of each document and ``failed_bits``, a bit for each failed rule."""
    bits = F.lit(0).cast("long")
    for rule in RULES.values():
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), rule.mask).otherwise(0).cast("long"))
    return measurements(docs).withColumn("failed_bits", bits)


def apply_policy(rows: DataFrame, version: int) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(policy_mask(version)).cast("long"))
    return rows.withColumn("kept", failed == 0)


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and each of its rules: how many documents the policy rejects, and how many
    it would keep without the rule. Documents are counted by bit pattern first, of which there are
    at most 2 to the number of rules."""
    patterns = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = F.array(
        *(
            F.struct(
                F.lit(version).alias("policy"),
                F.lit(name).alias("rule"),
                F.lit(policy_mask(version)).cast("long").alias("mask"),
                F.lit(RULES[name].mask).cast("long").alias("bit"),
            )
            for version, names in POLICIES.items()
            for name in names
        )
    )
    seen = patterns.select("failed_bits", "n", F.inline(cases))
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    return seen.groupBy("policy", "rule").agg(
        F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("rejected_by_it_alone"),
    )
