"""Packing by lexical retrieval: a window holds documents that resemble its seed.

Documents are dealt into shards by ranges of a lexical signature (the least hash of their token
ids), so that copies and documents of one vocabulary tend to meet, and a shard has some
``SHARD_TOKENS`` tokens whatever repeats: ties are broken by doc_id. Within a shard an inverted
index with BM25 weights returns, for each seed, the neighbours not used yet, best first: all terms
of the seed that have a positive weight count. They fill the window; the one that doesn't fit is
cut, its rest opens the next window and is its seed. If no neighbour is left, the next unused document follows. So every window is full but the last of a
shard, which is cut into sequences of a power of two tokens each and needs no padding either.

A task holds one shard: its ids and an index of the same order of size.

Nulls and odd rows: a null or empty text has the end id alone. A null doc_id is packed like any
other. Rows of one doc_id are packed one by one, and their pieces can't be told apart by doc_id.
An empty table gives no pieces. Extra columns are left behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

from .inputs import texts
from .memory import forgetting, remembering
from .tokens import IDS, Encoder

#: Tokens of a shard, about.
SHARD_TOKENS = 2_000_000
#: BM25: saturation of term counts, weight of the length.
K1, B = 1.2, 0.75
#: Neighbours sorted at first; further ones as they are asked for, four times as many each time.
SORTED = 64

ENCODED_SCHEMA = "doc_id long, signature long, n_tokens long, ids binary"
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _hashes(ids: np.ndarray) -> np.ndarray:
    held = ids * np.uint64(0x9E3779B97F4A7C15)
    return (held ^ (held >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids in as few bytes as the largest id needs: two up to 65535."""
    end = np.array([end_id], IDS).tobytes()

    @remembering
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        size = encoder.tokenizer.get_vocab_size()
        wide = size > 1 << 16 or end_id >= 1 << 16
        short_end = b"" if wide else np.array([end_id], "<u2").tobytes()
        hashes = _hashes(np.arange(size, dtype=np.uint64))
        for batch in batches:
            signatures, counts, packed = [], [], []
            for text in batch.column("text"):
                plain = encoder(text.as_py())
                ids = np.frombuffer(plain, IDS)
                signatures.append(int(hashes[ids].min() >> np.uint64(1)) if ids.size else 0)
                counts.append(ids.size + 1)
                packed.append(plain + end if wide else ids.astype("<u2").tobytes() + short_end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signatures, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                names=["doc_id", "signature", "n_tokens", "ids"],
            )

    return texts(docs).mapInArrow(encode, ENCODED_SCHEMA)


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and how often each occurs."""
    held, counts = np.unique(ids, return_counts=True)
    return held, counts.astype(np.int32)


class Bm25:
    """Inverted index over the documents of a shard. Terms in more than half of them have no
    weight."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        self.n = len(docs)
        # A term's number in the shard stands for it, in four bytes, so that an index is some
        # sixteen bytes a posting; what only serves to build it goes at once.
        counted = [_counted(ids) for ids in docs]
        distinct = [t.size for t, _ in counted]
        term = np.concatenate([t for t, _ in counted]) if counted else np.zeros(0, "<u4")
        count = np.concatenate([c for _, c in counted]) if counted else np.zeros(0, np.int32)
        del counted
        self.terms, number, self.sizes = np.unique(term, return_inverse=True, return_counts=True)
        number = number.astype(np.int32)
        self.own = np.split(number, np.cumsum(distinct)[:-1]) if distinct else []
        self.first = np.cumsum(self.sizes) - self.sizes
        order = np.argsort(term, kind="stable")
        del term
        self.doc = np.repeat(np.arange(self.n, dtype=np.int32), distinct)[order]
        count = count[order]
        del order
        self.idf = np.log((self.n - self.sizes + 0.5) / (self.sizes + 0.5))
        length = np.array([ids.size for ids in docs], np.float64)
        scale = K1 * (1 - B + B * length / max(length.mean(), 1)) if self.n else length
        self.weight = scale[self.doc]
        self.weight += count
        np.divide(count, self.weight, out=self.weight)
        self.weight *= np.repeat(self.idf * (K1 + 1), self.sizes)
        self.names = np.arange(self.n)

    def neighbours(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term of positive weight with the seed, best first, ties
        in the order of the documents."""
        self._shrink(used)
        terms = self.own[seed]
        terms = terms[(self.idf[terms] > 0) & (self.sizes[terms] > 0)]
        if not terms.size:
            return
        begins = self.first[terms].tolist()
        spans = [slice(at, at + n) for at, n in zip(begins, self.sizes[terms].tolist())]
        rows = np.concatenate([self.doc[span] for span in spans])
        scores = np.bincount(rows, np.concatenate([self.weight[span] for span in spans]), self.names.size)
        scores[used[self.names]] = 0
        found = np.flatnonzero(scores > 0)
        ranks, size = -scores[found], SORTED
        while found.size:
            best = np.ones(found.size, bool)
            if found.size > size:
                best = ranks <= np.partition(ranks, size)[size]
            yield from self.names[found[best][np.argsort(ranks[best], kind="stable")]].tolist()
            found, ranks, size = found[~best], ranks[~best], 4 * size

    def _shrink(self, used: np.ndarray) -> None:
        """Postings without used documents, once these are half. The weights stay as they are."""
        live = ~used[self.names]
        if 2 * np.count_nonzero(live) > live.size:
            return
        held = live[self.doc]
        before = np.concatenate([[0], np.cumsum(held)])
        ends = before[self.first + self.sizes]
        self.first = before[self.first]
        self.sizes = ends - self.first
        places = (np.cumsum(live) - 1).astype(np.int32)
        self.doc, self.weight = places[self.doc[held]], self.weight[held]
        self.names = self.names[live]


def retrieval_order(docs: list[np.ndarray], lengths: np.ndarray, window: int) -> list[int]:
    """The documents in the order in which they fill windows."""
    index, used = Bm25(docs), np.zeros(len(docs), bool)
    order: list[int] = []
    at, fresh, seed = 0, 0, None

    def take(doc: int) -> bool:
        """Whether the document reaches the end of the window or goes beyond."""
        nonlocal at
        used[doc] = True
        order.append(doc)
        at += int(lengths[doc])
        over, at = at >= window, at % window
        return over

    while len(order) < len(docs):
        if seed is None or at == 0:
            while used[fresh]:
                fresh += 1
            seed = fresh
            take(seed)
            if at == 0:
                continue
        for doc in index.neighbours(seed, used):
            if take(doc):
                seed = doc
                break
        else:
            seed = None
    return order


def cuts(total: int, window: int) -> np.ndarray:
    """Where sequences begin in a stream of tokens, and its end: full windows, then powers of two."""
    ends = list(range(window, total + 1, window))
    rest, at = total % window, total - total % window
    for power in range(window.bit_length(), -1, -1):
        if rest >> power & 1:
            at += 1 << power
            ends.append(at)
    return np.array([0, *ends], np.int64)


def _pieces(shard: int, docs: list[tuple[int | None, np.ndarray]], window: int) -> pa.RecordBatch:
    order = retrieval_order([ids[:-1] for _, ids in docs], np.array([ids.size for _, ids in docs]), window)
    lengths = np.array([docs[i][1].size for i in order], np.int64)
    begins = np.cumsum(lengths) - lengths
    sequences = cuts(int(lengths.sum()), window)
    starts = np.union1d(begins, sequences[:-1])
    doc = np.searchsorted(begins, starts, "right") - 1
    sequence = np.searchsorted(sequences, starts, "right") - 1
    length = np.diff(np.append(starts, sequences[-1]))
    start = starts - begins[doc]
    crcs = [
        zlib.crc32(docs[order[d]][1][s : s + n].astype(IDS).tobytes())
        for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())
    ]
    ids = [docs[i][0] for i in order]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[d] for d in doc.tolist()], pa.int64()),
            pa.array(start),
            pa.array(length),
            pa.array(crcs, pa.int64()),
            pa.array(lengths[doc]),
            pa.array(sequence + (shard << 32)),
            pa.array(starts - sequences[sequence]),
        ],
        names=[pair.split()[0] for pair in PIECE_SCHEMA.split(", ")],
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096) -> DataFrame:
    """A row per piece: where it lies in its document and in its sequence, and the crc32 of its
    ids as little-endian unsigned 32-bit integers. ``window`` is a power of two."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    encoded = stage(_encoded(docs, tokenizer, end_id), "packing")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // SHARD_TOKENS))

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            ids, counts = batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist()
            for doc_id, packed, n in zip(batch.column("doc_id").to_pylist(), ids, counts):
                held.append((doc_id, np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4")))
        if held:
            yield _pieces(TaskContext.get().partitionId(), held, window)

    return (
        encoded.repartitionByRange(shards, "signature", "doc_id")
        .sortWithinPartitions("signature", "doc_id", "ids")
        .mapInArrow(run, PIECE_SCHEMA)
    )
