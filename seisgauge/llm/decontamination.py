"""Benchmark decontamination by greedy string tiling.

Five-word seeds join documents with benchmark items. Of the words that a document and an item
share in seeds, the longest run found in both is marked, then the longest of what is left, and so on
until no run of five words is left. A search looks for runs of one length at a time, by a running
Karp-Rabin hash over both sides, and closes in on the longest length that both hold; runs of equal
hash are compared word by word before they are marked. The tiles' share of an item's words is its
coverage, whatever the order of the tiles, so a passage with its sentences moved about is caught.
A document that covers an item to ``least`` or more is not kept.

Words are runs of letters, digits and ``_``, lower-cased; in scripts that put no blanks between
words each character is one. An item of fewer than five words is sought as a whole and judged the
other way round: its coverage is the share of the *document's* words that lie in its occurrences, as
the words "which is true" in a long text are no copy of a question.

A run of equal words gives one seed, however long it is, and places of one hash are walked once, so
repeated words cost time in proportion to the texts, not to the product of their places.

The benchmark goes to the tasks as sorted arrays of seeds, in blocks of about ``BLOCK_BYTES`` of
text (one item, if it alone has more); each block is one pass over the documents, and the blocks'
findings are combined by document. Nothing of a document leaves its task but its findings.

Nulls and odd rows: a null or empty text matches nothing. Items whose text is null or has no word
are left out. An item without an id is sought as any other and reported as null. Repeated items
count once for each row; the best item is the one of the highest coverage, then the least item_id,
null last. Documents are judged by doc_id, so rows of one doc_id share the verdict of the worst. An
empty benchmark keeps all. Extra columns are left behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .inputs import texts
from .memory import forgetting
from .word_hashes import mixed, word_hashes

#: Words of a seed and of the shortest tile; share of an item's words that condemns a document.
SEED, LEAST = 5, 0.5
#: Bytes of benchmark text in a block. A seed takes 12 bytes beside its text.
BLOCK_BYTES = 16_000_000

# Thai to Burmese, Khmer, kana, and Han characters: scripts without blanks between words.
_SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_SINGLE}]|[^\W{_SINGLE}]+")
_SLOTS = 1 << 22
# An odd number, and the number that gives 1 with it modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)

FOUND_SCHEMA = "doc_id long, item_id long, coverage double, n_items long"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Running:
    """Karp-Rabin hashes of runs of any length: a polynomial modulo 2^64, kept as running sums."""

    def __init__(self, values: np.ndarray) -> None:
        powers = np.full(values.size, _BASE, np.uint64)
        back = np.full(values.size, _BACK, np.uint64)
        if values.size:
            powers[0] = back[0] = 1
        self.sums = np.zeros(values.size + 1, np.uint64)
        np.cumsum(values * np.cumprod(powers, dtype=np.uint64), dtype=np.uint64, out=self.sums[1:])
        self.back = np.cumprod(back, dtype=np.uint64)

    def runs(self, length: int) -> np.ndarray:
        """A hash for each run of ``length`` values; none if there are fewer."""
        count = max(self.back.size - length + 1, 0)
        held = (self.sums[length:] - self.sums[:-length])[:count] * self.back[:count]
        return mixed(held + np.uint64(length))


class _Side:
    """Words of one text by number, and which of them no tile covers."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.numbers = numbers
        # The numbers are small; the bijection makes the coefficients of the polynomial large.
        self.hashes = Running(mixed(numbers.astype(np.uint64) + np.uint64(1)))
        self.taken = numbers < 0

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the runs of ``length`` words that no tile touches."""
        held = np.concatenate([[0], np.cumsum(self.taken)])
        at = np.flatnonzero(held[length:] == held[:-length])
        return at, self.hashes.runs(length)[at]

    def longest(self) -> int:
        edges = np.flatnonzero(np.concatenate([[True], self.taken, [True]]))
        return int(np.diff(edges).max()) - 1


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``hashes`` occur in ``known``, which is sorted."""
    if not known.size:
        return np.zeros(hashes.size, bool)
    return known[np.minimum(np.searchsorted(known, hashes), known.size - 1)] == hashes


def _mark(here: _Side, there: _Side, length: int) -> list[tuple[int, int, int]]:
    """Marks runs of ``length``, the first free place of the document with the first free place of
    the item that holds the same words, and so on."""
    places, hashes = here.free(length)
    others, keys = there.free(length)
    order = np.lexsort((others, keys))
    others, keys = others[order], keys[order]
    wanted = _among(hashes, keys)
    places, hashes = places[wanted], hashes[wanted]
    if not places.size:
        return []
    begin = np.searchsorted(keys, hashes, "left").tolist()
    ends = np.searchsorted(keys, hashes, "right").tolist()
    partners, nexts, chosen, last = others.tolist(), {}, [], -1
    for at, first, end in zip(places.tolist(), begin, ends):
        if at < last:
            continue
        k = nexts.get(first, first)
        # All tiles of this round are of one length: one that overlaps covers an end.
        while k < end and (there.taken[partners[k]] or there.taken[partners[k] + length - 1]):
            k += 1
        nexts[first] = k
        words = here.numbers[at : at + length]
        while k < end:
            to = partners[k]
            busy = there.taken[to] or there.taken[to + length - 1]
            if not busy and np.array_equal(words, there.numbers[to : to + length]):
                here.taken[at : at + length] = True
                there.taken[to : to + length] = True
                chosen.append((at, to, length))
                last = at + length
                break
            k += 1  # other words of the same hash, or taken
    return chosen


def tiles(here: np.ndarray, there: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (place in the document, place in the item, words) of two arrays of word numbers, below
    0 for words that match nothing: always the longest run common to what is left of both, of equal
    ones the first of the document, then of the item."""
    sides, chosen = (_Side(here), _Side(there)), []
    most = min(side.longest() for side in sides)

    def shared(length: int) -> bool:
        _, hashes = sides[0].free(length)
        _, known = sides[1].free(length)
        return bool(_among(hashes, np.sort(known)).any())

    while most >= least and shared(least):
        low, high = least, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        chosen += _mark(*sides, low)
        most = min(low - 1, *(side.longest() for side in sides))
    return chosen


class Block:
    """Benchmark items (item_id, text, repeats), ready for the seeds of documents."""

    def __init__(self, items: Iterable[tuple]) -> None:
        self.items, seeds, owners, self.lengths = [], [], [], set()
        for item_id, text, *repeats in items:
            words = words_of(text)
            if not words:
                continue
            length = min(len(words), SEED)
            held = np.unique(Running(word_hashes(words)).runs(length))
            seeds.append(held)
            owners.append(np.full(held.size, len(self.items), np.int32))
            self.lengths.add(length)
            self.items.append((item_id, text, len(words), repeats[0] if repeats else 1))
        self.seeds = np.concatenate([np.zeros(0, np.uint64), *seeds])
        self.owners = np.concatenate([np.zeros(0, np.int32), *owners])
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owners = self.seeds[order], self.owners[order]
        self.slots = np.zeros(_SLOTS, bool)
        self.slots[(self.seeds >> np.uint64(42)).astype(np.int64)] = True

    def _shared(self, running: Running, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """Items that share seeds, and the seeds' places in the document."""
        hashes = running.runs(length)
        spots = np.flatnonzero(self.slots[(hashes >> np.uint64(42)).astype(np.int64)])
        spots = spots[_among(hashes[spots], self.seeds)]
        if not spots.size:
            return
        order = spots[np.argsort(hashes[spots], kind="stable")]
        seeds, starts = np.unique(hashes[order], return_index=True)
        places = np.split(order, starts[1:])
        left, right = (np.searchsorted(self.seeds, seeds, side) for side in ("left", "right"))
        counts = right - left
        which = np.repeat(np.arange(seeds.size), counts)
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        owners = self.owners[np.repeat(left, counts) + steps]
        by_item = np.argsort(owners, kind="stable")
        owners, which = owners[by_item], which[by_item]
        found, firsts = np.unique(owners, return_index=True)
        for item, mine in zip(found.tolist(), np.split(which, firsts[1:])):
            if min(self.items[item][2], SEED) == length:
                yield item, np.sort(np.concatenate([places[k] for k in mine.tolist()]))

    def findings(self, text: str, least: float) -> tuple[int | None, float, int] | None:
        """Best item, its coverage, and how many items are covered to ``least``."""
        words = words_of(text)
        running = Running(word_hashes(words))
        best, count = None, 0
        for length in sorted(self.lengths):
            for item, places in self._shared(running, length):
                item_id, given, size, repeats = self.items[item]
                found = covered(words, places, words_of(given))
                if not found:
                    continue
                covers = found / (size if size >= SEED else len(words))
                count += repeats * (covers >= least)
                rank = (-covers, item_id is None, item_id or 0)
                best = rank if best is None else min(best, rank)
        return best and (None if best[1] else best[2], -best[0], count)


def covered(words: list[str], places: np.ndarray, item: list[str]) -> int:
    """Words of a document that tiles cover (seeds start at ``places``). An item shorter than a seed
    is sought again behind each occurrence."""
    length = min(len(item), SEED)
    if len(item) < SEED:
        total, last = 0, 0
        for at in places.tolist():
            if at >= last and words[at : at + length] == item:
                total, last = total + length, at + length
        return total
    numbers: dict[str, int] = {}
    there = np.array([numbers.setdefault(word, len(numbers)) for word in item], np.int64)
    # Only words that lie in seeds can lie in tiles; a word in between stands for each gap.
    inside = np.unique((places[:, None] + np.arange(length)).ravel())
    found = np.array([numbers.get(words[k], -1) for k in inside.tolist()], np.int64)
    gaps = np.flatnonzero(np.diff(inside) > 1) + 1
    return sum(n for _, _, n in tiles(np.insert(found, gaps, -1), there))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("repeats"))
    # Bytes, so that a block is as small in any script.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-2 * total // BLOCK_BYTES))  # twice as many, as the items are dealt unevenly
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        yield [tuple(r) for r in rows]


def findings(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """A row per document that shares a tile with an item: doc_id, item_id (the one covered best),
    coverage, n_items (items covered to ``least``)."""
    spark, rows, passes = docs.sparkSession, texts(docs), []
    for items in _blocks(benchmark):
        built = Block(items)
        if not built.items:
            continue
        sent = spark.sparkContext.broadcast(built)

        @forgetting
        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                found = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    hit = block.findings(text.as_py(), least)
                    if hit:
                        found.append((doc_id, *hit))
                columns = list(zip(*found)) or [(), (), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                    names=["doc_id", "item_id", "coverage", "n_items"],
                )

        passes.append(rows.mapInArrow(run, FOUND_SCHEMA))
    if not passes:
        return spark.createDataFrame([], FOUND_SCHEMA)
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    order = F.struct(-F.col("coverage"), F.col("item_id").isNull(), F.col("item_id"))
    best = F.min_by("item_id", order)
    return every.groupBy("doc_id").agg(
        best.alias("item_id"), F.max("coverage").alias("coverage"), F.sum("n_items").alias("n_items")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """A row per document: doc_id, item_id, coverage, n_items, kept."""
    found = findings(docs, benchmark, least)
    n_items = F.coalesce("n_items", F.lit(0))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        .join(found.withColumnRenamed("doc_id", "_doc"), F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
        .select(
            "doc_id", "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
            n_items.alias("n_items"), (n_items == 0).alias("kept"),
        )
    )
