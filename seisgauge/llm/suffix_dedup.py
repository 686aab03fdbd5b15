"""Repeated substrings by merging the Burrows-Wheeler transforms of shards.

Every 200-byte string that starts anywhere else, in any document or the same one, is a repeat; each
byte under one is removed. Matches never cross documents.

Segments of possible repeats (see ``segments``) are dealt by fingerprint, so all places of one
string meet in one task. There the bodies form shards, each shard's suffixes are sorted on their
own, and the shards' transforms are merged by iterative interleave refinement: if the merged order
is right for the first k symbols, then going through it and dealing each suffix's predecessor to
the bucket of its preceding symbol gives the order for k + 1 (in the same way eight symbols are dealt
at a time, by the rank of the eight among all). Blocks of suffixes alike so far split
in the step that is their common prefix. A block of one suffix is settled, and so are its
predecessors, so only blocks of several are carried on; those left at 200 symbols are the repeated
intervals. No suffix is compared with one of another shard.

A body that occurs twice as it is needs no merge: all its windows are repeats. So is all of a
document of 200 bytes or more that occurs twice. A body alone with its fingerprint, whose gram
stands in it once, has no repeat.

Nulls and odd rows: a null or empty text has no bytes and an empty remainder. Repeated rows repeat
each other. A null doc_id is a document like any other. An empty table works. Extra columns are
left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

from .memory import forgetting
from .segments import (
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
    true_runs,
    unpacked_text,
)
from .word_hashes import mixed

#: Bytes of a repeat, and of the grams of fingerprints.
REPEAT, GRAM = 200, 64
#: Bytes of bodies merged at once at most, about, and the shards they form. The bodies of a
#: fingerprint that has more go by their windows.
MERGED, SHARDS = 2_000_000, 8
#: Bytes of the bodies of several fingerprints that are merged at once: few stay in the caches.
AT_ONCE = 250_000
#: Bodies that need no merge that are told at once.
ROWS = 10_000
#: Symbols dealt at a step.
DEALT = 8

FOUND_SCHEMA = "print long, body_hash long, starts array<int>, ends array<int>"
CLEANED_SCHEMA = "doc_no long, number long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _grams(text: bytes, gram: int) -> np.ndarray:
    """Hashes of all strings of ``gram`` (a power of two) bytes, by doubling."""
    held, size = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1), 1
    if held.size < gram:
        return held[:0]
    while size < gram:
        held = held[:-size] * np.uint64(pow(0x9E3779B97F4A7C15, size, 1 << 64)) + held[size:]
        size *= 2
    return mixed(held)


def byte_units(repeat: int = REPEAT, gram: int = GRAM) -> Units:
    def parse(text: str) -> tuple[bytes, np.ndarray]:
        held = text.encode("utf-8", "surrogatepass")
        return held, _grams(held, gram)

    return Units(repeat, gram, parse, lambda held, start, end: held[start:end])


class Transform:
    """Burrows-Wheeler transform of a shard: its suffixes in order (``places``), the symbol before
    each (0 at the start of a text) and the row of the suffix one longer."""

    def __init__(self, texts: list[bytes]) -> None:
        # UTF-8 has no byte 255, so bytes move up by one and 0 ends a text.
        symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, np.int64)
        ends = np.repeat(
            np.append(self.starts[1:], symbols.size) - 1, [len(t) + 1 for t in texts]
        )
        self.places = self._sorted(symbols, ends - np.arange(symbols.size), max(map(len, texts), default=0))
        rows = np.empty(symbols.size, np.int32)
        rows[self.places] = np.arange(symbols.size, dtype=np.int32)
        before = self.places - 1
        self.before = np.where(before >= 0, symbols[before], 0).astype(np.uint8)
        self.longer = rows[before]

    @staticmethod
    def _sorted(symbols: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
        """Places in the order of their suffixes, each up to the end of its text: by eight symbols,
        then those still alike by the ranks of what follows, twice as far each time."""
        n = symbols.size
        key = np.zeros(n, np.uint64)
        padded = np.append(symbols, np.zeros(8, np.uint8))
        for k in range(8):
            key = key << np.uint64(8) | np.where(left >= k, padded[k : k + n], 0).astype(np.uint64)
        order = np.argsort(key, kind="stable")
        first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = heads
        ahead = 8
        while ahead <= longest:
            alike = ~first | ~np.append(first[1:], True)
            spots = np.flatnonzero(alike)
            if not spots.size:
                break
            held = order[spots]
            beyond = np.where(left[held] >= ahead, rank[np.minimum(held + ahead, n - 1)] + 1, 0)
            turn = np.lexsort((held, beyond, rank[held]))
            held, beyond = held[turn], beyond[turn]
            order[spots] = held
            old = rank[held]
            fresh = np.concatenate([[True], (old[1:] != old[:-1]) | (beyond[1:] != beyond[:-1])])
            first[spots] = fresh
            rank[held] = np.maximum.accumulate(np.where(fresh, spots, 0))
            ahead *= 2
        return order


def repeated_places(shards: list[Transform], depth: int) -> list[np.ndarray]:
    """For each shard, the places whose first ``depth`` symbols occur in several places of all
    shards: the interleave is refined ``depth`` times."""
    sizes = [shard.places.size for shard in shards]
    offsets = np.cumsum([0, *sizes])
    one = np.concatenate([shard.before for shard in shards])
    longer = np.concatenate([shard.longer + np.int32(at) for shard, at in zip(shards, offsets)])
    # Several symbols at a step: those before are the lower bytes, and their rank stands for them. 0
    # where one is missing.
    several, further, whole = np.zeros(one.size, np.uint64), np.arange(one.size, dtype=np.int32), True
    for k in range(DEALT):
        symbol = one[further]
        several |= symbol.astype(np.uint64) << np.uint64(8 * k)
        whole, further = whole & (symbol > 0), longer[further]
    ranks = np.unique(np.append(np.uint64(0), np.where(whole, several, 0)), return_inverse=True)[1][1:]
    # Rows of all transforms in the order of their first k symbols, and which of them are alike.
    rows, block = np.arange(offsets[-1], dtype=np.int32), np.zeros(offsets[-1], np.int32)
    single, ranks = (one.astype(np.uint32), longer), (ranks.astype(np.uint32), further)
    for before, further in [single] * (depth % DEALT) + [ranks] * (depth // DEALT):
        symbol = before[rows]
        inner = np.flatnonzero(symbol)
        if inner.size < rows.size:
            rows, block, symbol = rows[inner], block[inner], symbol[inner]
        if not rows.size:
            break
        # By the lower half, then the upper, as halves are sorted by counting.
        turn = np.argsort(symbol.astype(np.uint16), kind="stable")
        upper = (symbol >> np.uint32(16)).astype(np.uint16)
        if upper.any():
            turn = turn[np.argsort(upper[turn], kind="stable")]
        rows, block, symbol = further[rows[turn]], block[turn], symbol[turn]
        split = np.empty(rows.size + 1, bool)
        split[0] = split[-1] = True
        split[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        left = np.flatnonzero(~(split[:-1] & split[1:]))
        block = np.cumsum(split[:-1], dtype=np.int32)[left]
        rows = rows[left]
    shard = np.searchsorted(offsets, rows, "right") - 1
    return [s.places[rows[shard == k] - offsets[k]] for k, s in enumerate(shards)]


def repeated_windows(bodies: list[bytes], depth: int = REPEAT) -> list[np.ndarray]:
    """For each body, a flag for each of its strings of ``depth`` bytes: whether it occurs in
    several places of all bodies."""
    flags = [np.zeros(max(0, len(body) - depth + 1), bool) for body in bodies]
    dealt = [range(k, len(bodies), SHARDS) for k in range(min(SHARDS, len(bodies)))]
    shards = [Transform([bodies[i] for i in own]) for own in dealt]
    for own, shard, places in zip(dealt, shards, repeated_places(shards, depth)):
        which = np.searchsorted(shard.starts, places, "right") - 1
        within = places - shard.starts[which]
        order = np.argsort(which, kind="stable")
        which, within = which[order], within[order]
        cut = np.searchsorted(which, np.arange(len(own) + 1))
        for k, i in enumerate(own):
            flags[i][within[cut[k] : cut[k + 1]]] = True
    return flags


def _found(body: Body, flags: np.ndarray) -> tuple | None:
    starts, ends = true_runs(flags)
    return (body.print, body.hash, starts.tolist(), ends.tolist()) if starts.size else None


def _repeats(found: DataFrame, units: Units) -> DataFrame:
    """For each body, the runs of its windows that are repeats."""
    depth, gram = units.window, units.gram

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Body] = []
        size = 0
        rows: list[tuple] = []

        def settle() -> pa.RecordBatch:
            flags = repeated_windows([body.body for body in held], depth) if held else []
            # A body seen twice is a repeat as it stands.
            rows.extend(row for b, f in zip(held, flags) if (row := _found(b, f | (b.copies > 1))))
            return batch_of(FOUND_SCHEMA, list(zip(*rows)) or [()] * 4)

        for group in fingerprint_groups(batches):
            body = group[0]
            if len(group) == 1 and body.copies > 1:
                rows.append((body.print, body.hash, [0], [body.n]))
            elif len(group) > 1 or (_grams(body.body, gram).view(np.int64) == body.print).sum() > 1:
                held.extend(group)
                size += sum(len(body.body) for body in group)
            if size >= min(AT_ONCE, MERGED) or len(rows) >= ROWS:
                yield settle()
                held, size, rows = [], 0, []
        yield settle()

    small, large = by_size(found, units, MERGED)
    repeats = grouped(small, sights=2).mapInArrow(run, FOUND_SCHEMA)
    if large is None:
        return repeats
    windows = by_window(large, 2, lambda body: [body[at : at + depth] for at in range(len(body) - depth + 1)])
    return repeats.unionByName(windows.drop("least"))


def _described(held: bytes) -> tuple[int, str]:
    return len(held), hashlib.sha256(held).hexdigest()


def remove_repeats(docs: DataFrame, repeat: int = REPEAT, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the
    remaining bytes as ``kept``."""
    units = byte_units(repeat, gram)
    found = stage(fingerprints(docs, units, _described, places=True), "prints")
    same = alike(found)
    held = stage(candidates(docs, found, same), "candidates")
    cut = stage(segments(held, units), "segments")
    ranges = (
        cut.select("doc_no", "number", "at", "print", "body_hash")
        .join(_repeats(cut, units), ["print", "body_hash"])
        .select("doc_no", "number", "at", F.explode(F.arrays_zip("starts", "ends")).alias("x"))
        .groupBy("doc_no", "number")
        # A document's own ranges, so no more than it has bytes.
        .agg(F.collect_set(F.struct((F.col("at") + F.col("x.starts")).alias("start"), (F.col("at") + F.col("x.ends")).alias("end"))).alias("ranges"))
    )

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = (batch.column(c).to_pylist() for c in ("doc_no", "number", "text", "ranges"))
            for doc_no, number, text, own in zip(*names):
                held = unpacked_text(text).encode("utf-8", "surrogatepass")
                gone = spans([r["start"] for r in own], [r["end"] + repeat - 1 for r in own])
                edges = [0, *(place for span in gone for place in span), len(held)]
                rest = b"".join(held[a:b] for a, b in zip(edges[0::2], edges[1::2]))
                digest = hashlib.sha256(rest).hexdigest()
                rows.append((doc_no, number, len(held) - len(rest), len(gone), digest, rest if with_text else None))
            yield batch_of(CLEANED_SCHEMA, list(zip(*rows)) or [()] * 6)

    key = ["doc_no", "number"]
    changed = held.select(*key, "text").join(ranges, key).mapInArrow(clean, CLEANED_SCHEMA)
    # Rows of one key have one text.
    changed = changed.dropDuplicates(key)
    copied = (F.col("copies") > 1) & (F.col("n_units") >= repeat)
    plain = (F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("sha256"))
    whole = (F.col("n_units"), F.lit(1).cast("long"), F.lit(hashlib.sha256().hexdigest()))
    told = [
        F.when(copied, all_).otherwise(F.coalesce(F.col(name), none)).alias(name)
        for name, all_, none in zip(("n_removed", "n_spans", "kept_sha256"), whole, plain)
    ]
    rows = (
        found.where("bucket is null").select(*key, "doc_id", "n_units", "sha256")
        .join(same.select("sha256", "copies"), "sha256")
        .join(changed, key, "left")
    )
    if not with_text:
        return rows.select("doc_id", F.col("n_units").alias("n_bytes"), *told)
    full = keyed(docs).select(*key, "text").dropDuplicates(key)
    kept = F.when(copied, F.lit(b"")).otherwise(F.coalesce(F.col("kept"), F.col("text").cast("binary")))
    return rows.join(full, key).select("doc_id", F.col("n_units").alias("n_bytes"), *told, kept.alias("kept"))
