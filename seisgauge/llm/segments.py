"""Windows that may repeat, brought together by a fingerprint of their content.

A window (so many bytes, or so many words) has as its fingerprint the least hash of the grams in
it, so equal windows have equal fingerprints, and consecutive windows mostly share one. A segment
is a run of consecutive windows of one fingerprint. A fingerprint that occurs once in all texts
can't be that of a repeated window, so only segments of the others leave their document.

The steps, each a Spark job over all documents:

1. ``fingerprints``: what each document is, and its fingerprints, without their lowest bits. A task
   knows by itself that those it sees several times are shared; of each fingerprint it sends one
   entry, packed with others;
2. ``listed``: entries of different contents that several tasks sent are shared, too. So a
   fingerprint of a third of all documents is one entry for each task;
3. ``candidates``: documents with shared fingerprints, with their text, packed. Of documents of the
   same units only the first is taken, its copies need no look: nor does what only they share;
4. ``segments``: their segments. Each task gives the body of a segment where it first sees it;
5. ``by_size``: fingerprints whose bodies are too many for a task are set apart;
6. ``grouped``: the bodies of the others, dealt by fingerprint, for the work of an operator. Bodies
   that occur often come once from each task at most;
7. ``by_window``: the bodies set apart are cut into their windows, and these are counted by the
   hash of the whole window, so no task holds a fingerprint;
8. the operator's findings on bodies go back to the documents by a join on the bodies' hash.

Documents are known by ``doc_no``, a hash of id and text, and ``number``, the id or a number above
all ids, so repeated rows and null ids work. Bodies are known by fingerprint and a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

from .inputs import texts
from .memory import forgetting

#: Windows of a segment at most: a long run of one fingerprint (a text of one letter) is cut.
LONGEST = 4096

#: Greater than any doc_id.
NOBODY = (1 << 63) - 1

#: Lowest bits that fingerprints leave out where they are told apart before texts are at hand: so
#: some more are taken for shared, and each takes two bytes less.
LEFT_OUT = np.uint64(16)

FINGERPRINT_SCHEMA = (
    "doc_no long, number long, doc_id long, n_units long, sha256 string, owner long, "
    "prints array<long>, bucket int, entries binary"
)
LISTED_SCHEMA = "owner long, prints array<long>"
CANDIDATE_SCHEMA = "doc_no long, number long, text binary"
WINDOW_SCHEMA = "print long, body_hash long, copies long, least long, place int, key binary"
RUN_SCHEMA = "print long, body_hash long, starts array<int>, ends array<int>, least array<long>"
SEGMENT_SCHEMA = (
    "doc_no long, number long, at long, n long, print long, body_hash long, body binary, sight int"
)


@dataclass(frozen=True)
class Units:
    """What windows are made of. ``parse`` gives the units of a text and the hashes of its grams;
    ``body`` the bytes of the units from one place to another."""

    window: int
    gram: int
    parse: Callable[[str], tuple[Sequence, np.ndarray]]
    body: Callable[[Sequence, int, int], bytes]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima of blocks."""
    n = values.size
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(grams: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first window and number of windows of each run."""
    least = sliding_least(grams, units.window - units.gram + 1)
    if not least.size:
        return least, np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[starts], starts, np.diff(np.append(starts, least.size))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_no, number, doc_id, text."""
    return texts(docs).select(
        F.xxhash64("doc_id", "text").alias("doc_no"),
        F.coalesce("doc_id", F.lit(NOBODY)).alias("number"),
        "doc_id",
        "text",
    )


def batch_of(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    fields = [pair.split() for pair in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def packed(prints: np.ndarray, owners: np.ndarray) -> bytes:
    """Sorted fingerprints and the owner of each (0: several), in some six bytes."""
    steps = np.diff(prints, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    known, place = np.unique(owners, return_inverse=True)
    head = np.array([prints.size, known.size], "<u4").tobytes()
    plain = head + planes + known.astype("<i8").tobytes() + place.astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(plain)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(blob)
    n, known = np.frombuffer(plain, "<u4", 2).tolist()
    steps = np.ascontiguousarray(np.frombuffer(plain, np.uint8, 8 * n, 8).reshape(8, n).T)
    owners = np.frombuffer(plain, "<i8", known, 8 + 8 * n)
    place = np.frombuffer(plain, "<u4", n, 8 + 8 * n + 8 * known)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), owners[place]


#: Fingerprints that a task holds before it sends them.
HELD = 2_000_000


def fingerprints(
    docs: DataFrame, units: Units, described: Callable[[Sequence], tuple[int, str]], places: bool
) -> DataFrame:
    """Rows of documents, with the fingerprints known to be shared in ``prints``, and rows of
    packed ``entries`` for a ``bucket``. With ``places`` a fingerprint whose gram stands in two
    places of one document is shared, otherwise it takes two documents of different units.
    ``described`` gives n_units and sha256, whose first 64 bits make the ``owner``."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = [prints.size for *_, prints, _ in held]
        if not held:
            return
        prints = np.concatenate([prints for *_, prints, _ in held])
        counts = np.concatenate([counts for *_, counts in held])
        owner = np.repeat(np.arange(len(held)), sizes)
        order = np.argsort(prints, kind="stable")
        values, first = np.unique(prints[order], return_index=True)
        total = np.add.reduceat(counts[order], first) if values.size else counts
        several = total > 1
        shared = np.zeros(prints.size, bool)
        shared[order] = np.repeat(several, np.diff(np.append(first, prints.size)))
        ends = np.cumsum(sizes)
        own = [prints[e - n : e][shared[e - n : e]].view(np.int64) for e, n in zip(ends.tolist(), sizes)]
        numbers = [list(column) for column in list(zip(*held))[:6]]
        nothing = [None] * len(held)
        yield batch_of(FINGERPRINT_SCHEMA, [*numbers, own, nothing, nothing])
        names = np.array(numbers[5], np.int64)
        owners = np.where(several, 0, names[owner[order[first]]] if values.size else 0)
        bucket = ((values >> np.uint64(4)) % np.uint64(buckets)).astype(np.int32)
        found = [int(b) for b in np.unique(bucket)]
        blobs = [packed(values[bucket == b], owners[bucket == b]) for b in found]
        nothing = [None] * len(found)
        yield batch_of(FINGERPRINT_SCHEMA, [*[nothing] * 7, found, blobs])

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        met: set[str] = set()
        size = 0
        for batch in batches:
            names = (batch.column(c).to_pylist() for c in ("doc_no", "number", "doc_id"))
            for doc_no, number, doc_id, text in zip(*names, batch.column("text")):
                parts, grams = units.parse(text.as_py())
                n_units, sha256 = described(parts)
                prints = np.unique(runs(grams[:0] if sha256 in met else grams, units)[0])
                counts = np.ones(prints.size, np.int64)
                if places and prints.size:
                    at = np.minimum(np.searchsorted(prints, grams), prints.size - 1)
                    counts = np.bincount(at[prints[at] == grams], minlength=prints.size)
                owner = int(sha256[:16], 16) - (1 << 63) or 1
                held.append((doc_no, number, doc_id, n_units, sha256, owner, prints >> LEFT_OUT, counts))
                met.add(sha256)
                size += prints.size
                if size > HELD:
                    yield from settle(held)
                    held, size = [], 0
                    met.clear()
        yield from settle(held)

    return keyed(docs).mapInArrow(run, FINGERPRINT_SCHEMA)


def listed(found: DataFrame) -> DataFrame:
    """Owners and their shared fingerprints, from the rows of ``fingerprints``."""

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [unpacked(blob.as_py()) for batch in batches for blob in batch.column("entries")]
        if not blobs:
            return
        prints, owners = (np.concatenate(part) for part in zip(*blobs))
        order = np.argsort(prints, kind="stable")
        prints, owners = prints[order], owners[order]
        first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        # Copies in several tasks are of one owner. That of several in a task differs from all.
        several = np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)
        shared = np.repeat(several, np.diff(np.append(first, prints.size))) & (owners != 0)
        prints, owners = prints[shared], owners[shared]
        order = np.argsort(owners, kind="stable")
        prints, owners = prints[order].view(np.int64), owners[order]
        new = np.append(True, (prints[1:] != prints[:-1]) | (owners[1:] != owners[:-1]))[: prints.size]
        prints, owners = prints[new], owners[new]
        names, first = np.unique(owners, return_index=True)
        for at in range(0, names.size, 10_000):
            cuts = np.append(first, prints.size)[at : at + 10_001]
            lists = [prints[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield batch_of(LISTED_SCHEMA, [names[at : at + 10_000], lists])

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = found.where("bucket is not null").select("bucket", "entries")
    across = sent.repartition(parts, "bucket").select("entries").mapInArrow(run, LISTED_SCHEMA)
    within = found.where("bucket is null and size(prints) > 0").select("owner", "prints")
    # As many lists as there are buckets, and of each task that saw a copy one: the same for copies
    # in tasks with nothing else that shares them.
    return (
        within.unionByName(across).groupBy("owner").agg(F.flatten(F.collect_set("prints")).alias("shared"))
    )


def alike(found: DataFrame) -> DataFrame:
    """For each sha256: how many documents have it, and the first of them by number."""
    return (
        found.where("bucket is null").groupBy("sha256", "owner")
        .agg(F.count("*").alias("copies"), F.min("number").alias("first"), F.min_by("doc_no", F.struct("number", "doc_no")).alias("first_no"))
    )


def candidates(docs: DataFrame, found: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc_no, number, text (see ``unpacked_text``) and shared fingerprints of the documents that
    have some, the first of those alike (rows of ``alike``)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packs = [compress(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_no"), batch.column("number"), pa.array(packs, pa.binary())],
                names=["doc_no", "number", "text"],
            )

    named = firsts.select("owner", F.col("first_no").alias("doc_no"), F.col("first").alias("number"))
    wanted = listed(found).join(named, "owner").drop("owner")
    packs = keyed(docs).select("doc_no", "number", "text").mapInArrow(pack, CANDIDATE_SCHEMA)
    return packs.join(wanted, ["doc_no", "number"])


def unpacked_text(packed_text: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(packed_text).decode("utf-8", "surrogatepass")


def segments(held: DataFrame, units: Units) -> DataFrame:
    """A row per segment: its document, first window, number of windows, fingerprint, the hash of
    its body and, at its first sight in the task, its body. ``sight`` counts to 3 at most.
    Documents are seen in the order of their numbers within a task."""

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            names = (batch.column(c).to_pylist() for c in ("doc_no", "number"))
            for doc_no, number, text, shared in zip(*names, batch.column("text"), batch.column("shared")):
                held, grams = units.parse(unpacked_text(text.as_py()))
                prints, starts, sizes = runs(grams, units)
                known = np.sort(shared.values.to_numpy().view(np.uint64))
                short = prints >> LEFT_OUT
                spot = np.minimum(np.searchsorted(known, short), known.size - 1)
                wanted = np.flatnonzero(known[spot] == short)
                for value, first, count in zip(
                    prints[wanted].view(np.int64).tolist(), starts[wanted].tolist(), sizes[wanted].tolist()
                ):
                    for at in range(first, first + count, LONGEST):
                        n = min(LONGEST, first + count - at)
                        body = units.body(held, at, at + n + units.window - 1)
                        digest = xxhash.xxh3_64_intdigest(body) - (1 << 63)
                        sight = seen[digest] = min(3, seen.get(digest, 0) + 1)
                        rows.append((doc_no, number, at, n, value, digest, body if sight == 1 else None, sight))
            yield batch_of(SEGMENT_SCHEMA, list(zip(*rows)) or [()] * 8)

    dealt = held.sortWithinPartitions("number", "doc_no")
    return dealt.select("doc_no", "number", "text", "shared").mapInArrow(run, SEGMENT_SCHEMA)


def by_size(found: DataFrame, units: Units, bound: int) -> tuple[DataFrame, DataFrame | None]:
    """The segments of fingerprints whose bodies have ``bound`` units at most, and those of the
    others, if there are any. A body counts once for each task that saw it."""
    sizes = found.where("sight = 1").groupBy("print").agg(F.sum(F.col("n") + (units.window - 1)).alias("size"))
    large = stage(sizes.where(F.col("size") > bound).select("print"), "large")
    if not large.take(1):
        return found, None
    # No more than all units by the bound.
    few = F.broadcast(large)
    return found.join(few, "print", "left_anti"), found.join(few, "print", "left_semi")


def by_window(found: DataFrame, sights: int, windows: Callable[[bytes], list[bytes]]) -> DataFrame:
    """For each body of the segments, the runs of its windows that stand in several places, with
    the least document of each run. ``windows`` cuts a body. Windows are told apart by 128 bits."""
    bodies = (
        found.where(F.col("sight") <= sights)
        .groupBy("print", "body_hash")
        .agg(F.count("*").alias("copies"), F.min("number").alias("least"), F.max("body").alias("body"))
    )

    @forgetting
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = (batch.column(c).to_pylist() for c in ("print", "body_hash", "copies", "least"))
            for *numbers, body in zip(*names, batch.column("body")):
                keys = [xxhash.xxh3_128_digest(held) for held in windows(body.as_py())]
                columns = [[number] * len(keys) for number in numbers]
                yield batch_of(WINDOW_SCHEMA, [*columns, list(range(len(keys))), keys])

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, digest, held in zip(*(batch.column(c).to_pylist() for c in ("print", "body_hash", "places"))):
                held = sorted((x["place"], x["least"]) for x in held)
                first = [k for k, (at, least) in enumerate(held) if not k or (at - 1, least) != held[k - 1]]
                last = [k - 1 for k in [*first[1:], len(held)]]
                starts, least = zip(*(held[k] for k in first))
                rows.append((value, digest, starts, [held[k][0] + 1 for k in last], least))
            yield batch_of(RUN_SCHEMA, list(zip(*rows)) or [()] * 5)

    each = stage(bodies.select("print", "body_hash", "copies", "least", "body").mapInArrow(cut, WINDOW_SCHEMA), "windows")
    # Combined in each task first, so a window of all documents is a row per task. Staged, so that
    # adaptive execution can split such a window in the join.
    known = each.groupBy("key").agg(F.sum("copies").alias("n"), F.min("least").alias("first"))
    several = stage(known.where("n > 1"), "several")
    return (
        each.select("print", "body_hash", "place", "key")
        .join(several.select("key", "first"), "key")
        .groupBy("print", "body_hash")
        # A body has LONGEST windows at most.
        .agg(F.collect_list(F.struct("place", F.col("first").alias("least"))).alias("places"))
        .mapInArrow(joined, RUN_SCHEMA)
    )


def grouped(found: DataFrame, sights: int) -> DataFrame:
    """The segments with at most so many sights in their task, dealt and sorted by fingerprint and
    body, those with the body itself first."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        found.where(F.col("sight") <= sights)
        .select("print", "body_hash", "n", "number", "body")
        .repartition(parts, "print")
        .sortWithinPartitions("print", "body_hash", F.col("body").isNull())
    )


@dataclass
class Body:
    print: int
    hash: int
    n: int
    body: bytes
    copies: int
    least: int


def fingerprint_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[Body]]:
    """From the rows of ``grouped``: the bodies of one fingerprint, each with the number of its
    rows and the least number of them."""
    group: list[Body] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and group[-1].print != row["print"]:
                yield group
                group = []
            if not group or group[-1].hash != row["body_hash"]:
                group.append(Body(row["print"], row["body_hash"], row["n"], row["body"], 0, row["number"]))
            last = group[-1]
            last.copies += 1
            last.least = min(last.least, row["number"])
    if group:
        yield group


def spans(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Runs of places that are covered by any of the ranges."""
    merged: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [tuple(span) for span in merged]


def true_runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]
