"""Repeated passages by suffix automata of reference shards.

A word goes if a window of 13 words that covers it also starts in a document of a smaller id.

Windows that may repeat are dealt by fingerprint (see ``segments``), so the references of a shard
are all that can match its documents, and a shard's automaton goes to the one task that streams
them. The automaton of a shard is built once over its distinct passages; each state knows the least
doc_id of the passages that contain its strings. The passages are then streamed through it: at each
word the state of the longest match is cut back to the window, which gives the least document that
has the window. Spans where this is smaller than the document itself are removed.

A fingerprint with a single passage needs no automaton: the least document is the passage's. Nor do
documents of the same words: all but the first lose everything, if they have a window at all.

Nulls and odd rows: a null or blank text has no words. Repeated rows have one doc_id, so neither
removes the other, but both lose what a smaller document has. A null doc_id is smaller than none
and greater than any: its document loses what others have and takes nothing. An empty table works.
Extra columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

from .inputs import words
from .memory import forgetting
from .segments import (
    NOBODY,
    Body,
    Units,
    alike,
    batch_of,
    by_size,
    by_window,
    candidates,
    fingerprint_groups,
    fingerprints,
    grouped,
    keyed,
    segments,
    spans,
    unpacked_text,
)
from .word_hashes import run_hashes, word_hashes

#: Words of a window, and of the grams of fingerprints.
WINDOW, GRAM = 13, 6
#: Words of a shard, about; the bodies of a fingerprint that has more go by their windows.
SHARD_WORDS = 300_000
#: Bodies without an automaton that are told at once.
ROWS = 10_000

FOUND_SCHEMA = "print long, body_hash long, starts array<int>, ends array<int>, least array<long>"
CLEANED_SCHEMA = "doc_no long, number long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def word_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    def parse(text: str) -> tuple[list[bytes], np.ndarray]:
        held = words_of(text)
        return held, run_hashes(word_hashes(held), gram)

    return Units(window, gram, parse, lambda held, start, end: b" ".join(held[start:end]))


class Automaton:
    """Suffix automaton of several passages of words. A state's strings have lengths above that of
    its link, up to its own ``size``; ``least`` is the least document that contains them."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.least = [-1], [0], [NOBODY]

    def add(self, words: list[bytes], doc_id: int) -> None:
        """A passage; earlier ones are unaffected as none runs on into it."""
        next_, link, size, least = self.next, self.link, self.size, self.least
        last = 0
        for word in words:
            known = next_[last].get(word)
            if known is not None and size[known] == size[last] + 1:
                last = known
                if doc_id < least[last]:
                    least[last] = doc_id
                continue
            if known is not None:
                last = self._clone(last, word, known)
                if doc_id < least[last]:
                    least[last] = doc_id
                continue
            fresh = len(size)
            next_.append({})
            link.append(0)
            size.append(size[last] + 1)
            least.append(doc_id)
            at = last
            while at >= 0 and word not in next_[at]:
                next_[at][word] = fresh
                at = link[at]
            if at >= 0:
                known = next_[at][word]
                link[fresh] = known if size[known] == size[at] + 1 else self._clone(at, word, known)
            last = fresh

    def _clone(self, at: int, word: bytes, known: int) -> int:
        copy = len(self.size)
        self.next.append(dict(self.next[known]))
        self.link.append(self.link[known])
        self.size.append(self.size[at] + 1)
        self.least.append(self.least[known])
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def finish(self) -> None:
        """Hands each state's least document to the shorter strings that end where its own do."""
        least, link = self.least, self.link
        for state in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            if least[state] < least[link[state]]:
                least[link[state]] = least[state]

    def matches(self, words: list[bytes], window: int) -> list[int]:
        """For each window of the words, the least document that contains it."""
        next_, link, size = self.next, self.link, self.size
        state, length, found = 0, 0, []
        for place, word in enumerate(words, 1):
            step = next_[state].get(word)
            while step is None and state:
                state = link[state]
                length = size[state]
                step = next_[state].get(word)
            if step is None:
                length = 0
            else:
                state, length = step, length + 1
            # The state whose strings include the last ``window`` words.
            while length > window and size[link[state]] >= window:
                state = link[state]
                length = size[state]
            if place >= window:
                found.append(self.least[state] if length >= window else NOBODY)
        return found


def least_documents(bodies: list[tuple[bytes, int]], window: int = WINDOW) -> list[np.ndarray]:
    """For each body, words joined by blanks, the least document of each of its windows."""
    automaton = Automaton()
    split = [body.split(b" ") for body, _ in bodies]
    for words, (_, doc_id) in zip(split, bodies):
        automaton.add(words, doc_id)
    automaton.finish()
    return [np.array(automaton.matches(words, window), np.int64) for words in split]


def _found(body: Body, least: np.ndarray) -> tuple | None:
    """Runs of windows of one least document, unless there is none that is before the body's."""
    if body.copies == 1 and least.min() == body.least:
        return None
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(starts[1:], least.size)
    return body.print, body.hash, starts.tolist(), ends.tolist(), least[starts].tolist()


def _windows(body: bytes, window: int) -> list[bytes]:
    held = body.split(b" ")
    return [b" ".join(held[at : at + window]) for at in range(len(held) - window + 1)]


def _least_by_window(found: DataFrame, units: Units) -> DataFrame:
    window = units.window

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Body] = []
        size = 0
        rows: list[tuple] = []

        def settle() -> pa.RecordBatch:
            least = least_documents([(b.body, b.least) for b in held], window)
            rows.extend(row for row in map(_found, held, least) if row)
            return batch_of(FOUND_SCHEMA, list(zip(*rows)) or [()] * 5)

        for group in fingerprint_groups(batches):
            if len(group) == 1:
                # Nothing smaller than the first document that has it: nothing to tell unless
                # others have it, too.
                body = group[0]
                if body.copies > 1:
                    rows.append((body.print, body.hash, [0], [body.n], [body.least]))
            else:
                held.extend(group)
                size += sum(body.n + window - 1 for body in group)
            if size >= SHARD_WORDS or len(rows) >= ROWS:
                yield settle()
                held, size, rows = [], 0, []
        yield settle()

    small, large = by_size(found, units, SHARD_WORDS)
    least = grouped(small, sights=2).mapInArrow(run, FOUND_SCHEMA)
    if large is None:
        return least
    return least.unionByName(by_window(large, 2, lambda body: _windows(body, window)))


def _described(held: list[bytes]) -> tuple[int, str]:
    return len(held), hashlib.sha256(b" ".join(held)).hexdigest()


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, n_spans, kept_sha256 and, if asked for, the
    remaining words joined by blanks as ``kept`` (bytes)."""
    units = word_units(window, gram)
    found = stage(fingerprints(docs, units, _described, places=False), "prints")
    same = alike(found)
    held = stage(candidates(docs, found, same), "candidates")
    cut = stage(segments(held, units), "segments")
    ranges = (
        cut.select("doc_no", "number", "at", "print", "body_hash")
        .join(_least_by_window(cut, units), ["print", "body_hash"])
        .select("doc_no", "number", "at", F.explode(F.arrays_zip("starts", "ends", "least")).alias("x"))
        .where("x.least < number")
        .groupBy("doc_no", "number")
        # A document's own ranges, so no more than it has words.
        .agg(F.collect_set(F.struct((F.col("at") + F.col("x.starts")).alias("start"), (F.col("at") + F.col("x.ends")).alias("end"))).alias("ranges"))
    )

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = (batch.column(c).to_pylist() for c in ("doc_no", "number", "text", "ranges"))
            for doc_no, number, text, own in zip(*names):
                held = words_of(unpacked_text(text))
                gone = spans([r["start"] for r in own], [r["end"] + window - 1 for r in own])
                edges = [0, *(place for span in gone for place in span), len(held)]
                rest = [word for a, b in zip(edges[0::2], edges[1::2]) for word in held[a:b]]
                joined = b" ".join(rest)
                digest = hashlib.sha256(joined).hexdigest()
                rows.append((doc_no, number, len(held) - len(rest), len(gone), digest, joined if with_text else None))
            yield batch_of(CLEANED_SCHEMA, list(zip(*rows)) or [()] * 6)

    key = ["doc_no", "number"]
    changed = held.select(*key, "text").join(ranges, key).mapInArrow(clean, CLEANED_SCHEMA)
    # By the first of those alike, which have the same words.
    changed = changed.dropDuplicates(key).select(
        F.col("doc_no").alias("first_no"), F.col("number").alias("first"), "n_removed", "n_spans", "kept_sha256", "kept"
    )
    later = (F.col("number") > F.col("first")) & (F.col("n_units") >= window)
    plain = (F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("sha256"))
    whole = (F.col("n_units"), F.lit(1).cast("long"), F.lit(hashlib.sha256().hexdigest()))
    told = [
        F.when(later, all_).otherwise(F.coalesce(F.col(name), none)).alias(name)
        for name, all_, none in zip(("n_removed", "n_spans", "kept_sha256"), whole, plain)
    ]
    rows = (
        found.where("bucket is null").select(*key, "doc_id", "n_units", "sha256")
        .join(same.drop("owner"), "sha256")
        .join(changed, ["first_no", "first"], "left")
    )
    if not with_text:
        return rows.select("doc_id", F.col("n_units").alias("n_words"), *told)
    full = keyed(docs).select(*key, F.array_join(words(F.col("text")), " ").cast("binary").alias("text"))
    kept = F.when(later, F.lit(b"")).otherwise(F.coalesce("kept", "text"))
    return rows.join(full.dropDuplicates(key), key).select(
        "doc_id", F.col("n_units").alias("n_words"), *told, kept.alias("kept")
    )
