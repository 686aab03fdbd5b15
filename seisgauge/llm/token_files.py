"""Token files: the ids of documents in independent zstandard frames behind a seek table.

A shard is a file in the seekable zstandard format. A frame holds the ids of one document, as
little-endian unsigned 32-bit integers, or a part of at most ``FRAME_IDS`` of them. A skippable
frame at the end lists, for each frame, its compressed and plain size and a checksum (the low half
of the plain bytes' XXH64), so a reader seeks to the frames of the documents asked for and
decompresses nothing else.

Documents are dealt by ranges of doc_id, so shards and the documents in them ascend. A task writes
a file of its own name and returns one index row per document; the index is a Parquet table, which
Spark commits. A task that runs again writes another file, and only the one whose rows were
committed is ever read.

Nulls and odd rows: a null or empty text has the end id alone. A null doc_id sorts first. Rows of
one doc_id are kept, ordered by text. An empty table gives an empty index. Extra columns are left
behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .inputs import texts
from .memory import forgetting, remembering
from .tokens import IDS, Encoder

FRAME_IDS = 1 << 20
LEVEL = 3

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")

INDEX_SCHEMA = (
    "shard long, path string, doc_id long, start long, n_tokens long, frame long, n_frames long"
)


class ShardWriter:
    def __init__(self, sink) -> None:
        self.sink = sink
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.table = bytearray()
        self.frames = 0

    def add(self, ids: bytes) -> tuple[int, int]:
        """Writes one document; its first frame and how many it has."""
        first = self.frames
        for at in range(0, max(len(ids), 1), FRAME_IDS * IDS.itemsize):
            plain = ids[at : at + FRAME_IDS * IDS.itemsize]
            packed = self.compressor.compress(plain)
            self.sink.write(packed)
            self.table += ENTRY.pack(len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)
            self.frames += 1
        return first, self.frames - first

    def close(self) -> None:
        size = len(self.table) + FOOTER.size
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, size) + self.table)
        self.sink.write(FOOTER.pack(self.frames, CHECKSUM_FLAG, SEEKABLE_MAGIC))
        self.sink.close()


class ShardReader:
    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a seekable zstandard file with checksums")
        source.seek(size - FOOTER.size - frames * ENTRY.size)
        table = np.frombuffer(source.read(frames * ENTRY.size), "<u4").reshape(frames, 3)
        self.packed, self.plain, self.checksums = table[:, 0].tolist(), table[:, 1], table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)]).tolist()
        self.decompressor = zstandard.ZstdDecompressor()

    def read(self, frame: int, count: int) -> bytes:
        self.source.seek(self.starts[frame])
        parts = []
        for at in range(frame, frame + count):
            plain = self.decompressor.decompress(
                self.source.read(self.packed[at]), max_output_size=max(1, int(self.plain[at]))
            )
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checksums[at]:
                raise ValueError(f"frame {at} doesn't match its checksum")
            parts.append(plain)
        return b"".join(parts)


def write_token_files(
    docs: DataFrame, root: str, tokenizer: str, end_id: int | None = None
) -> DataFrame:
    """Writes ``docs`` (doc_id, text) below ``root``, which all executors reach, and returns the
    index. ``tokenizer`` is a file that the executors have, ``end_id`` closes each document."""
    spark = docs.sparkSession
    end = b"" if end_id is None else np.array([end_id], IDS).tobytes()

    @remembering
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode, writer, start, path = Encoder.of(tokenizer), None, 0, ""
        for batch in batches:
            if writer is None and batch.num_rows:
                path = f"{root}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
                files, place = fs.FileSystem.from_uri(path)
                files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                writer = ShardWriter(files.open_output_stream(place, compression=None))
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py()) + end
                frame, count = writer.add(ids)
                n = len(ids) // IDS.itemsize
                rows.append((shard, path, doc_id, start, n, frame, count))
                start += n
            yield _table(rows, INDEX_SCHEMA)
        if writer is not None:
            writer.close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{root}/index")
    return token_index(spark, root)


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [pair.split() for pair in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, _ARROW[kind]) for values, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def token_index(spark: SparkSession, root: str) -> DataFrame:
    """A row per document: its shard, file, ids before it in the shard, ids, frames."""
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index")


READ_SCHEMA = "shard long, doc_id long, start long, n_tokens long, ids binary"
DIGEST_SCHEMA = "shard long, doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(index: DataFrame, digest: bool = False) -> DataFrame:
    """The ids of the documents in ``index``, which may be any part of a token index; only their
    frames are read. ``digest`` gives the crc32 of the ids in place of the ids."""
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = DIGEST_SCHEMA if digest else READ_SCHEMA

    @forgetting
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, rows, held = None, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != at:
                    at = row["path"]
                    files, place = fs.FileSystem.from_uri(at)
                    reader = ShardReader(files.open_input_file(place))
                ids = reader.read(row["frame"], row["n_frames"])
                n = len(ids) // IDS.itemsize
                if n != row["n_tokens"]:
                    raise ValueError(f"{at}: {n} ids of document {row['doc_id']}, not {row['n_tokens']}")
                rows.append((row["shard"], row["doc_id"], row["start"], n, zlib.crc32(ids) if digest else ids))
                held += 0 if digest else len(ids)
                if held > 1 << 24:
                    yield _table(rows, schema)
                    rows, held = [], 0
            yield _table(rows, schema)
            rows, held = [], 0

    # A shard's rows come together; ranges spread the shards evenly.
    dealt = index.repartitionByRange(parts, "shard").sortWithinPartitions("shard", "frame")
    return dealt.mapInArrow(read, schema)


def with_global_starts(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Turns ``start`` within the shard into ids of all documents before. The running sum is over
    one row per shard."""
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("shard")) - F.col("_size")
    shards = sizes.select(F.col("shard"), before.alias("_before"))
    return rows.join(shards, "shard").withColumn("start", F.col("start") + F.col("_before")).drop("_before")
