"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document of label 1 is preferred to one of label 0. The weights minimise the logistic loss of
``w . (features of the preferred - features of the other)`` over pairs, so the score needs no
intercept and no balance of classes. The threshold is a quantile of the training scores: the share
of label 0 among the training labels. A document's score is the logistic function of its distance
from the threshold, so one half lies on it.

Fitting takes every labelled document. They are dealt by a hash of their ids over blocks of some
``per_block`` of the commoner label; of a rare label each comes to several blocks, so that every
block has pairs. A step of Newton's method adds up what the pairs of each block say, in a task per
few blocks, and only these sums reach the driver. The threshold is the exact quantile, found by counting
in ever narrower bins. However often an id and its label are repeated, the pair counts once. Of rows
that share an id the fit sees one, that of the least features. The share of label 0 is counted over
all training labels. Features
describe the text alone, whole, and are the same size for any text.

Nulls and odd rows: a null or blank text has features of zero and a score like any other. Labels
that are null, or of documents that are missing, are left out; a document with both labels counts
for both. If a label is missing altogether, every score is one half. Rows of one doc_id are scored
one by one. Extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .inputs import texts
from .memory import forgetting

#: Documents of the commoner label in a block, about, and of the other one at least, if there are.
PER_BLOCK, LEAST = 5000, 500
#: Pairs for each of these documents, penalty, steps of Newton's method.
PAIRS, PENALTY, STEPS = 8, 1e-3, 25
#: Bins of scores that are counted at a time.
BINS = 4096

FEATURES = (
    "log_words", "distinct_words", "word_length", "symbols_per_word", "marks_per_word", "capitals",
    "capital_words", "digits", "same_as_next", "repeated_pairs", "distinct_lines", "longest_word",
    "most_common",
)

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "#*$%&|<>@^~=_{}[]\\/"
_MARKS = "!?;:"
_DIGITS = "0123456789"


def _without(text: str, symbols: str) -> int:
    return sum(map(text.count, symbols))


def features(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    chars = sum(map(len, words))
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        np.log1p(n),
        len(counts) / n,
        chars / n,
        np.log1p(_without(text, _SYMBOLS) / n),
        np.log1p(_without(text, _MARKS) / n),
        _without(text, _CAPITALS) / chars,
        sum(c for word, c in counts.items() if len(word) > 1 and word.isupper()) / n,
        _without(text, _DIGITS) / chars,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(max(map(len, counts))),
        max(counts.values()) / n,
    ]


def _featured(rows: DataFrame) -> DataFrame:
    """doc_id and its features, in place of the text."""

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Ranking:
    """Scores are ``(x - mean) / scale . weights - threshold``, then the logistic function."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        far = ((x - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(far, -500, 500)))


def _unfitted() -> Ranking:
    width = len(FEATURES)
    return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)


def _pairs(good: np.ndarray, bad: np.ndarray, block: int = 0) -> np.ndarray:
    """Differences of a row of ``good`` and one of ``bad``, ``PAIRS`` for each row of the larger side."""
    chance = np.random.default_rng(7 + block)
    n = PAIRS * max(len(good), len(bad))
    return good[chance.permutation(n) % len(good)] - bad[chance.permutation(n) % len(bad)]


def _pair_sums(ahead: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of the pairs and sums of their slopes and curves, one after the other."""
    lost = 1 / (1 + np.exp(np.clip(ahead @ weights, -500, 500)))
    slope = (lost[:, None] * ahead).sum(0)
    curve = (ahead * (lost * (1 - lost))[:, None]).T @ ahead
    return np.concatenate([[len(ahead)], slope, curve.ravel()])


def _newton(sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights of the least loss, given the sums of :func:`_pair_sums` over all pairs."""
    width = len(FEATURES)
    weights = np.zeros(width)
    for _ in range(STEPS):
        found = sums(weights)
        n, lost, curves = found[0], found[1 : 1 + width], found[1 + width :].reshape(width, width)
        step = np.linalg.solve(curves / n + PENALTY * np.eye(width), PENALTY * weights - lost / n)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _scale(variances: np.ndarray) -> np.ndarray:
    scale = np.sqrt(variances)
    scale[scale < 1e-9] = 1.0
    return scale


def fit_pairs(good: np.ndarray, bad: np.ndarray, bad_share: float) -> Ranking:
    """Bradley-Terry over the pairs of one block."""
    if not len(good) or not len(bad):
        return _unfitted()
    # Both sides weigh the same, so that the scale doesn't follow the labels' shares.
    both = [good, bad]
    mean = sum(side.mean(0) for side in both) / 2
    scale = _scale(sum(((side - mean) ** 2).mean(0) for side in both) / 2)
    good, bad = (good - mean) / scale, (bad - mean) / scale
    ahead = _pairs(good, bad)
    weights = _newton(lambda weights: _pair_sums(ahead, weights))
    # The quantile at the share of label 0, each side weighing as much as it does in the labels.
    raw = np.concatenate([good @ weights, bad @ weights])
    weight = np.concatenate(
        [np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))]
    )
    order = np.argsort(raw, kind="stable")
    below = np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-12)
    ends = raw[order][[min(below, raw.size - 1), min(below + 1, raw.size - 1)]]
    return Ranking(mean, scale, weights, float(ends.mean()))


def _rows(values: pa.Scalar) -> np.ndarray:
    return np.asarray(values.values, np.float64).reshape(-1, len(FEATURES))


def _total(blocks: DataFrame, sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> np.ndarray:
    """What ``sums`` gives for the good rows, the bad ones and the number of a block, over all blocks
    that have both. Decimals add up to the same in any order."""

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, good, bad in zip(*(batch.column(name) for name in ("block", "good", "bad"))):
                found = sums(_rows(good), _rows(bad), block.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], names=["sums"])

    each = blocks.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    found = each.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,18)")).alias("sum")).collect()
    return np.array([float(row["sum"]) for row in sorted(found)])


def _dealt(found: DataFrame, sizes: dict[int, int], per_block: int) -> DataFrame:
    """A row per block: its number and the features of its good and of its bad documents."""
    n = -(-max(sizes.values()) // per_block)
    rare = min(sizes, key=lambda label: sizes[label])
    times = min(n, -(-LEAST * n // sizes[rare]))
    copies = F.when(F.col("quality") == rare, F.lit(times)).otherwise(F.lit(1))
    placed = found.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).withColumn(
        "block", F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(n)) + F.col("copy"), F.lit(n))
    )

    def side(label: int) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col("quality") == label, F.struct("doc_id", "x"))))
        return F.flatten(F.transform(rows, lambda row: row["x"]))

    blocks = placed.groupBy("block").agg(side(1).alias("good"), side(0).alias("bad"))
    return blocks.where((F.size("good") > 0) & (F.size("bad") > 0))


def _quantile(raw: DataFrame, weight: dict[int, float], share: float) -> float:
    """Midway between the ``raw`` at which the weights, in ascending order and label 1 first, reach
    ``share``, and that of the next row."""
    aim = share - 1e-12
    before, after = 0.0, None
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    while True:
        place = F.floor((F.col("raw") - low) / (high - low) * BINS) if low < high else F.lit(0)
        bins = (
            raw.where(F.col("raw").between(low, high))
            .groupBy(place.alias("place"))
            .agg(
                F.min("raw").alias("low"), F.max("raw").alias("high"),
                *[F.count(F.when(F.col("quality") == label, 1)).alias(f"n{label}") for label in (0, 1)],
            )
            .orderBy("place")
            .collect()
        )
        for k, row in enumerate(bins):
            here = row["n0"] * weight[0] + row["n1"] * weight[1]
            if before + here >= aim or k + 1 == len(bins):
                break
            before += here
        after = bins[k + 1]["low"] if k + 1 < len(bins) else after
        low, high = row["low"], row["high"]
        if low == high:
            last = weight[0] if row["n0"] else weight[1]
            more = after is None or row["n0"] + row["n1"] > 1 and before + here - last >= aim
            return low if more else (low + after) / 2


def fit(docs: DataFrame, labels: DataFrame, per_block: int = PER_BLOCK) -> Ranking:
    """``labels`` has doc_id and quality (0 or 1)."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).where("doc_id is not null and quality in (0, 1)")
    shares = {row["quality"]: row["n"] for row in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return _unfitted()
    bad_share = shares[0] / (shares[0] + shares[1])
    # Features are met by their labels, as they are much smaller than texts.
    each = _featured(texts(docs).where("doc_id is not null")).groupBy("doc_id").agg(F.min("x").alias("x"))
    found = stage(each.join(known.distinct(), "doc_id"), "features")
    sizes = {row["quality"]: row["n"] for row in found.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return _unfitted()
    blocks = stage(_dealt(found, sizes, per_block), "blocks")

    # Both sides weigh the same, so that the scale doesn't follow the labels' shares.
    def halves(of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        sums = _total(blocks, lambda good, bad, _: np.concatenate([[len(good), len(bad)], of(good).sum(0), of(bad).sum(0)]))
        good, bad = sums[2:].reshape(2, -1)
        return (good / sums[0] + bad / sums[1]) / 2

    mean = halves(lambda side: side)
    scale = _scale(halves(lambda side: (side - mean) ** 2))

    def sums(weights: np.ndarray) -> np.ndarray:
        return _total(
            blocks,
            lambda good, bad, block: _pair_sums(_pairs((good - mean) / scale, (bad - mean) / scale, block), weights),
        )

    weights = _newton(sums)

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, len(FEATURES))
            raw = ((x - mean) / scale) @ weights
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(raw)], names=["quality", "raw"])

    raw = stage(found.select("quality", "x").mapInArrow(run, "quality int, raw double"), "raw-scores")
    # The quantile at the share of label 0, each side weighing as much as it does in the labels.
    weight = {0: bad_share / sizes[0], 1: (1 - bad_share) / sizes[1]}
    return Ranking(mean, scale, weights, _quantile(raw, weight, bad_share))


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """A row per document: doc_id, score, predicted (1 from a score of one half)."""

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(text.as_py()) for text in batch.column("text")], np.float64)
            found = ranking.scores(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of ``docs``, whole, whose texts are predicted to be of label 1."""
    plain = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(text.as_py()) for text in batch.column("_text")], np.float64)
            good = ranking.scores(x.reshape(-1, len(FEATURES))) >= 0.5
            yield batch.filter(pa.array(good)).drop_columns(["_text"])

    return plain.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """A third of all ids, kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
