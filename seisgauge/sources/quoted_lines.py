"""Records of a CSV file whose quoted fields hold line breaks, from splits read side by side.

Whether a line begins inside a quoted field depends on all lines before it, yet every line can say
what it does to either answer: keep it, turn it round, or settle it. These effects combine in order:
along the lines of a split in its task, then along the splits of a file, of which there is one row
each. The same read keeps the ends of each split, parts of records that reach into other splits, for
either answer at its start. With the answer known every split is read once more and its lines are joined
to records in the task; of the ends, those that belong to the answer are shuffled and joined.
Both reads must cut the files alike: a split whose start was not seen before raises an error.

A quote opens a field only at its start, and a doubled one within it stands for itself. Records end
with a line feed, after an optional carriage return. A quote that is never closed would take in the
rest of its file: a record of more than ``LONGEST`` bytes raises an error. Empty files and folders
have no records.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .staging import stage

#: Bytes of the longest record that spans lines.
LONGEST = 16_000_000

_SPACE = r" \t\n\x0b\f\r"
_QUOTED = r'"[^"]*(?:""[^"]*)*'
# Whole fields, then one that is quoted and not closed. A quote that closes is followed by none, so
# there is one way to match, and bytes do for text: all that counts is ASCII.
_OPEN = (
    rf'^(?:[{_SPACE}]*(?:{_QUOTED}"(?:[^",][^,]*)?|[^",{_SPACE}][^,]*|),)*[{_SPACE}]*{_QUOTED}\z'
)


def _combined(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``settled`` (null if the answer depends on what was before) and ``turned`` of each row,
    combined with those of all rows before it."""
    along = Window.partitionBy(*keys).orderBy(order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.sum(F.when(F.col("settled").isNull() & F.col("turned"), 1).otherwise(0)).over(upto)
    last = F.last(
        F.when(F.col("settled").isNotNull(), F.struct("settled", "_turns")), ignorenulls=True
    ).over(upto)
    return (
        rows.withColumn("_turns", turns)
        .withColumn("_last", last)
        .withColumn("settled", F.col("_last.settled") != (_odd(F.col("_turns") - F.col("_last._turns"))))
        .withColumn("turned", _odd(F.col("_turns")))
        .withColumn("settled_before", F.lag("settled").over(along))
        .withColumn("turned_before", F.lag("turned").over(along))
        .drop("_turns", "_last")
    )


def _odd(number: Column) -> Column:
    return number % 2 == 1


def _state(settled: str, turned: str, entry: Column) -> Column:
    return F.coalesce(F.col(settled), entry != F.coalesce(F.col(turned), F.lit(False)))


def _ends(opened: np.ndarray, kept: np.ndarray, before: bool) -> np.ndarray:
    """Whether each line ends inside a quoted field, if the first one begins ``before``."""
    turns = np.cumsum(opened & ~kept)
    settled = np.maximum.accumulate(np.where(opened == kept, np.arange(len(opened)), -1))
    base = np.where(settled < 0, before, opened[settled])
    return base ^ ((turns - np.where(settled < 0, 0, turns[settled])) % 2 == 1)


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The runs of lines of one split, which are next to each other."""
    files, blocks = batch.column("file").dictionary_encode().indices, batch.column("block")
    keys = np.stack([np.asarray(files, np.int64), np.asarray(blocks, np.int64)])
    cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if begin < end:
            yield (batch["file"][begin].as_py(), batch["block"][begin].as_py()), batch.slice(begin, end - begin)


def _flags(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside a quoted field if it begins outside of one, and if inside."""
    opened, kept = np.zeros(len(values), bool), np.ones(len(values), bool)
    values = values.cast(pa.binary())
    quoted = pc.indices_nonzero(pc.match_substring(values, '"'))
    if len(quoted):
        lines = values.take(quoted)
        opened[quoted] = pc.match_substring_regex(lines, _OPEN).to_numpy(zero_copy_only=False)
        lines = pc.binary_join_element_wise(pa.scalar(b'"'), lines, pa.scalar(b""))
        kept[quoted] = pc.match_substring_regex(lines, _OPEN).to_numpy(zero_copy_only=False)
    return opened, kept


_PLACE = ("written", "file", "block", "row")
_PARTS = "written timestamp, file string, block long, row long, value string, first boolean, last boolean"


def _rows(places: pa.RecordBatch, values: pa.Array, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    columns = [*(places.column(name) for name in _PLACE), values, pa.array(first), pa.array(last)]
    return pa.RecordBatch.from_arrays(columns, names=[*_PLACE, "value", "first", "last"])


class _Split:
    """Joins the lines of a split, which come batch by batch, if the first of them begins ``inside``
    a quoted field or outside. What it has of a record that began before it or goes on after it has
    ``first`` or ``last`` false. A record that is too long raises an error, with ``ends`` it is null:
    then records that are whole are left out, and it may turn out that the answer was another."""

    def __init__(self, place: tuple, inside: bool, ends: bool = False) -> None:
        self.place, self.inside, self.ends = place, inside, ends
        self.held: list[str] | None = []
        self.size, self.begun = 0, None

    def _hold(self, lines: list[str]) -> None:
        self.size += _bytes(lines)
        if self.size > LONGEST and self.ends:
            self.held = None
        _bounded(0 if self.held is None else self.size, self.place)
        if self.held is not None:
            self.held.extend(lines)

    def _rest(self, last: bool) -> Iterator[pa.RecordBatch]:
        places, first = self.begun
        if not (self.ends and first and last):
            value = pa.array([None if self.held is None else "\n".join(self.held)], pa.string())
            yield _rows(places, value, np.array([first]), np.array([last]))
        self.held, self.size, self.begun = [], 0, None

    def add(self, lines: pa.RecordBatch, opened: np.ndarray, kept: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = _ends(opened, kept, self.inside)
        goes_on, self.inside = self.inside, bool(ends[-1])
        closed = np.flatnonzero(~ends)
        values = lines.column("value")
        begin = 0
        if goes_on:  # with what is held, or with what another split holds
            if self.begun is None:
                self.begun = (lines.slice(0, 1), False)
            begin = int(closed[0]) + 1 if len(closed) else lines.num_rows
            self._hold(values.slice(0, begin).to_pylist())
            if len(closed):
                yield from self._rest(True)
        end = max(begin, int(closed[-1]) + 1 if len(closed) else 0)
        if begin < end and not self.ends:
            first = ~np.concatenate([[goes_on], ends[:-1]])
            starts = np.flatnonzero(first[begin:end])
            offsets = pa.array(np.append(starts, end - begin).astype(np.int32))
            grouped = pa.ListArray.from_arrays(offsets, values.slice(begin, end - begin))
            joined = pc.binary_join(grouped, "\n")
            _bounded(pc.max(pc.binary_length(joined)).as_py(), self.place)
            whole = np.ones(len(starts), bool)
            yield _rows(lines.slice(begin, end - begin).take(pa.array(starts)), joined, whole, whole)
        if end < lines.num_rows:
            self.begun = (lines.slice(end, 1), True)
            self._hold(values.slice(end).to_pylist())

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.begun is not None:
            yield from self._rest(False)


# Rows of parts say which answer they are for; the one row of effects of a split says none.
_EFFECTS = f"{_PARTS}, inside boolean, settled boolean, turned boolean"


def _effects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split as a whole does to the answer, and its ends for either answer."""

    def marked(part: pa.RecordBatch, *marks: bool | None) -> pa.RecordBatch:
        columns = [*part.columns, *(pa.array([m] * part.num_rows, pa.bool_()) for m in marks)]
        return pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "inside", "settled", "turned"])

    def closed(first: pa.RecordBatch, either: list[_Split]) -> Iterator[pa.RecordBatch]:
        for inside, split in enumerate(either):
            for part in split.close():
                yield marked(part, bool(inside), None, None)
        ends = [split.inside for split in either]
        none = np.zeros(1, bool)
        row = _rows(first, pa.nulls(1, pa.string()), none, none)
        yield marked(row, None, ends[0] if ends[0] == ends[1] else None, ends[0] and not ends[1])

    at, first, either = None, None, []
    for batch in batches:
        for place, lines in _by_split(batch):
            if place != at:
                if at is not None:
                    yield from closed(first, either)
                at, first = place, lines.slice(0, 1)
                either = [_Split(place, inside, ends=True) for inside in (False, True)]
            flags = _flags(lines.column("value"))
            for inside, split in enumerate(either):
                # The first split of a file begins outside.
                if not inside or place[1]:
                    for part in split.add(lines, *flags):
                        yield marked(part, bool(inside), None, None)
                else:
                    split.inside = bool(_ends(*flags, split.inside)[-1])
    if at is not None:
        yield from closed(first, either)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a split, and what it has of others."""
    at, split = None, None
    for batch in batches:
        for place, lines in _by_split(batch):
            if place != at:
                if split is not None:
                    yield from split.close()
                at, split = place, _Split(place, lines["entry"][0].as_py())
            yield from split.add(lines, *_flags(lines.column("value")))
    if split is not None:
        yield from split.close()


def _not_too_long(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, value in zip(batch.column("file"), batch.column("value")):
            _bounded(0 if value.is_valid else LONGEST + 1, (file.as_py(),))
        yield batch


def _bytes(lines: list[str]) -> int:
    return sum(len(line.encode()) + 1 for line in lines)


def _bounded(size: int, place: tuple) -> None:
    if size > LONGEST:
        raise ValueError(f"a quote is not closed in {place[0]}")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` (a record, its lines joined by line feeds) and where its first line stands: written,
    file, block, row."""
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_modification_time").alias("written"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    # A few rows per split: dealt to be in fewer files than there are splits.
    seen = stage(lines.mapInArrow(_effects, _EFFECTS).repartition("file", "block"), "splits")
    effects = seen.where(F.col("inside").isNull()).select("file", "block", "settled", "turned")
    splits = stage(
        _combined(effects, ["file"], "block").select(
            "file", "block", _state("settled_before", "turned_before", F.lit(False)).alias("entry")
        ),
        "starts",
    )
    unseen = F.raise_error(F.concat(F.lit("cut another way than before: "), F.col("file"))).cast("boolean")
    # A row per split, so small enough to be broadcast. That keeps the order of the lines.
    placed = lines.join(F.broadcast(splits), ["file", "block"], "left").select(
        *_PLACE, "value", F.coalesce("entry", unseen).alias("entry")
    )
    whole = placed.mapInArrow(_parts, _PARTS).where(F.col("first") & F.col("last")).drop("first", "last")
    # Two parts of a split at most.
    torn = seen.join(F.broadcast(splits.withColumnRenamed("entry", "inside")), ["file", "block", "inside"])
    torn = stage(torn.select(*_PLACE, "value", "first", "last"), "parts").mapInArrow(_not_too_long, _PARTS)
    records = whole.unionByName(_spanning(torn))
    records = records.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    return records.where(F.trim("value") != "")


def _spanning(parts: DataFrame) -> DataFrame:
    """Records of more than one split, from their parts."""
    begin = F.when(F.col("first"), F.struct("block", "row"))
    along = Window.partitionBy("file", "block").orderBy("row")
    carried = (
        parts.groupBy("file", "block").agg(F.max(begin).alias("begin"))
        .withColumn(
            "carried",
            F.max("begin").over(
                Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .drop("begin")
    )
    keyed = (
        parts.withColumn("begin", F.last(begin, ignorenulls=True).over(along))
        .join(carried, ["file", "block"])
        .withColumn("begin", F.coalesce("begin", "carried"))
    )
    sizes = keyed.groupBy("file", "begin").agg(F.sum(F.octet_length("value") + 1).alias("size"))
    too_long = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))).cast("string")
    line = F.when(F.col("size") > LONGEST, too_long).otherwise(F.col("value"))
    lines = F.array_sort(F.collect_list(F.struct("block", "row", line.alias("value"))))
    return (
        keyed.join(sizes, ["file", "begin"])
        .groupBy("file", "begin")
        .agg(F.max("written").alias("written"), lines.alias("lines"))
        .select("written", "file", "begin.*", F.array_join("lines.value", "\n").alias("value"))
    )
