"""Documents with all that is odd: nulls, blanks, repeats, long texts, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(chance: random.Random, words: int) -> str:
    """Words from a small vocabulary, so that short runs repeat by chance."""
    vocabulary = ["the", "of", "and", "Stone", "river", "mühle,", "été", "saw.", "12", "x-y", "ñ", "a"]
    text = []
    for _ in range(words):
        word = chance.choice(vocabulary) + (str(chance.randrange(60)) if chance.random() < 0.6 else "")
        text.append(word + chance.choice([" ", " ", " ", "\n", "  ", "\t"]))
    return "".join(text)


def changed(chance: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"edit{chance.randrange(10_000)}"
    return " ".join(words)


def rows(seed: int = 1) -> list[tuple]:
    chance = random.Random(seed)
    texts: list[str | None] = [prose(chance, chance.choice([3, 30, 90, 200])) for _ in range(40)]
    passage = prose(chance, 70)
    for k in range(6):  # a shared passage, at various places
        texts.append(prose(chance, 20 + k) + passage + prose(chance, 30))
    base = prose(chance, 150)
    texts += [base] * 4  # exact copies
    texts += [changed(chance, base, k) for k in (1, 2, 5, 9, 14, 20)]  # near and less near ones
    texts += [texts[-6] + "tail", passage, passage + passage]
    texts += ["", "   \n\t ", None, "word", "a b c", "a b c", "a" * 3000, "a" * 2500 + "b", "ab " * 900]
    texts += [prose(chance, 9000)]
    texts += ["née <|endoftext|> İstanbul's 'LL don't   x y \x1c z", "\x0b\x0c\r mixed \x0bwhite\x0cspace\r"]
    ids: list[int | None] = list(range(len(texts)))
    chance.shuffle(ids)
    ids[3] = None
    ids[len(ids) - 5] = None
    found = [(i, t, None if k % 7 == 0 else "en", None, None) for k, (i, t) in enumerate(zip(ids, texts))]
    found += [found[0], found[0], found[45]]  # repeated rows
    found.append((ids[10], "another text under the same id, of some length, for good measure", "en", "s", 1))
    return found


#: Names that operators use for themselves.
CLASHING = (
    "node key comp least print prints spans kept score x u v center share ids signature shared body "
    "ranges listed possible rule verdict failed_bits n_words lines held url host path sha256 doc_key"
).split()


def documents(spark: SparkSession, given: list[tuple] | None = None, parts: int = 3) -> DataFrame:
    frame = spark.createDataFrame(rows() if given is None else given, SCHEMA).repartition(parts)
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("other"))
    return frame


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [], 1)
