"""Byte-level BPE: texts to token ids and back, by recursive DuckDB queries inside each task.

A vocabulary file lists tokens and their ranks. Two neighbouring tokens merge if their bytes
together are a token, whose rank is the pair's. A text is split into words by a pattern; each word
starts as one row for each byte, and a recursive query joins neighbours to the table of merges and
contracts, in every word at once, the leftmost pair of the least rank, until no pair is left. Words
that are a token as a whole are that token, as in the ``tiktoken`` library. Decoding looks up the
bytes of each id and puts them together by an ordered aggregation.

A task remembers the words it has encoded and the runs of ids it has decoded, up to a bound, so each
is worked out once for most of the task's texts; a run ends before a token that starts with a blank.
No state outlives the task but the table of merges, whose size is the vocabulary's.

Words of more than ``SHORT`` bytes take a round for each rank in place of one for each merge: all
pairs of the least rank that don't overlap, from the left, up to the first whose token could merge
with a neighbour at a lower rank still. That is the same order of merges.

Odd rows: a null text is empty, an empty text has no ids, null ids decode to no bytes. Rows with
null or repeated ids stay as they are, in any number. Bytes that aren't UTF-8 are replaced as Spark
does on its way to Arrow. An id that the vocabulary lacks is an error.
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words or runs remembered by a task: some 80 MB.
REMEMBERED = 400_000
#: Words of one recursive query, and the bytes of text taken at a time.
TOGETHER, SLICE = 20_000, 4_000_000
#: Bytes of a word that takes one merge a round.
SHORT = 100
IDS = np.dtype("<u4")

# Rows of a word: place and id. ``open`` until a round finds no pair in it any more.
_MERGE_LEFTMOST = """
with recursive state(word, pos, id, open) as (
    select word, pos, id, true from symbols
    union all
    (with pairs as (
        select a.word, a.pos, a.id as a, b.id as b
        from state a join state b on b.word = a.word and b.pos = a.pos + 1
        where a.open and b.open),
    least as (
        select word, min((merges.id::bigint << 32) | pos) as rank_and_pos
        from pairs join merges using (a, b) group by word),
    chosen as (
        select word, (rank_and_pos & 4294967295)::int as here, (rank_and_pos >> 32)::int as merged from least)
    select s.word, case when pos > here then pos - 1 else pos end, case when pos = here then merged else id end,
        here is not null
    from state s left join chosen c on c.word = s.word
    where s.open and pos is distinct from here + 1)
)
select word, pos, id from state where not open order by word, pos
"""

# A contracted pair leaves id -1 in its right place, so places stay as they are.
_MERGE_RUNS = """
with recursive state(word, pos, id) using key (word, pos) as (
    select word, pos, id from symbols
    union
    (with live as (
        select word, pos, id, row_number() over places as n, lead(pos) over places as right_pos,
            lead(id) over places as right_id, lag(id) over places as before, lead(id, 2) over places as after
        from recurring.state where id >= 0 and word in (select word from state)
        window places as (partition by word order by pos)),
    least as (
        select l.word, l.pos, l.n, right_pos, before, after, m.id as merged
        from live l join merges m on m.a = l.id and m.b = l.right_id
        qualify m.id = min(m.id) over (partition by l.word)),
    runs as (select *, n - row_number() over (partition by word order by n) as run from least),
    apart as (
        select *, row_number() over (partition by word, run order by n) as nth from runs
        qualify nth % 2 = 1),
    halts as (
        select p.word, min(p.n) as n
        from apart p
        left join merges l on l.a = (case when nth > 1 then merged else before end) and l.b = merged
        left join merges r on r.a = merged and r.b = after
        where l.id < merged or r.id < merged group by p.word),
    chosen as (
        select a.word, a.pos, right_pos, merged
        from apart a left join halts h on h.word = a.word where h.n is null or a.n <= h.n)
    select word, pos, merged from chosen union all select word, right_pos, -1 from chosen)
)
select word, pos, id from state where id >= 0 order by word, pos
"""

# With one thread and the order of insertion kept, the aggregation sees the rows as they are ordered;
# a sort inside the aggregation would be one for each of many small groups.
_DECODE = """
select run, unhex(string_agg(spelled, '')) as body
from (select run, spelled from runs join vocabulary using (id) order by run, pos)
group by run order by run
"""


class Vocabulary:
    """Ranks of a file and the merges they allow: a pair for each way to cut a token in two."""

    _open: dict[str, Vocabulary] = {}

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        ranks = self.ranks
        pairs = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        table = np.array(pairs, np.int32).reshape(-1, 3)
        self.merges = pa.table({name: table[:, k] for k, name in enumerate(("a", "b", "id"))})
        self.spelled = pa.table(
            {
                "id": pa.array(ranks.values(), pa.int32()),
                "spelled": pa.array([token.hex() for token in ranks], pa.string()),
            }
        )
        self.of_byte = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        #: For each id whether it is given out, and whether it starts with a blank.
        self.given, self.leads = np.zeros((2, max(ranks.values()) + 1), bool)
        self.given[[*ranks.values()]] = True
        self.leads[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """The worker's copy of this file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]


@contextmanager
def _database(tables: dict[str, pa.Table]) -> Iterator[duckdb.DuckDBPyConnection]:
    """A database of the task's own; what it can't hold goes to the worker's temporary folder."""
    with tempfile.TemporaryDirectory() as folder:
        settings = {"threads": 1, "memory_limit": "400MB", "temp_directory": folder, "preserve_insertion_order": True}
        with duckdb.connect(config=settings) as database:
            for name, table in tables.items():
                database.register("given", table)
                database.execute(f"create table {name} as select * from given")
                database.unregister("given")
            yield database


def _rows(held: list[bytes], width: int, ids: np.ndarray, group: str) -> pa.Table:
    """One row for each of ``ids``: which of ``held`` it is of, and its place there."""
    sizes = np.fromiter(map(len, held), np.int64, len(held)) // width
    starts = np.cumsum(sizes) - sizes
    places = np.arange(len(ids)) - np.repeat(starts, sizes)
    owners = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
    return pa.table({group: owners, "pos": places.astype(np.int32), "id": ids.astype(np.int32)})


def _portions(held: list[bytes], most: int) -> Iterator[list[bytes]]:
    """At most ``TOGETHER`` at a time, and some ``most`` bytes."""
    portion, size = [], 0
    for item in held:
        portion.append(item)
        size += len(item)
        if len(portion) == TOGETHER or size >= most:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


class _Words(dict):
    """Ids of words by the word, as bytes."""

    def __init__(self, vocabulary: Vocabulary, database: duckdb.DuckDBPyConnection) -> None:
        super().__init__()
        self.vocabulary, self.database = vocabulary, database

    def learn(self, words: Iterable[str]) -> None:
        short, long, ranks = [], [], self.vocabulary.ranks
        for word in words:
            body = word.encode()
            if body in ranks:
                self[word] = np.array([ranks[body]], IDS).tobytes()
            else:
                (short if len(body) <= SHORT else long).append(body)
        for bodies, query in ((short, _MERGE_LEFTMOST), (long, _MERGE_RUNS)):
            for portion in _portions(bodies, 40 * TOGETHER):
                self._merge(portion, query)

    def _merge(self, bodies: list[bytes], query: str) -> None:
        symbols = self.vocabulary.of_byte[np.frombuffer(b"".join(bodies), np.uint8)]
        self.database.register("symbols", _rows(bodies, 1, symbols, "word"))
        merged = self.database.sql(query).to_arrow_table()
        self.database.unregister("symbols")
        ends = 4 * np.cumsum(np.bincount(merged["word"].to_numpy(), minlength=len(bodies)))
        ids, start = merged["id"].to_numpy().astype(IDS).tobytes(), 0
        for body, end in zip(bodies, ends.tolist()):
            self[body.decode()] = ids[start:end]
            start = end


class _Runs(dict):
    """Bytes of runs of ids by the run, both as bytes."""

    def __init__(self, database: duckdb.DuckDBPyConnection) -> None:
        super().__init__()
        self.database = database

    def learn(self, runs: Iterable[bytes]) -> None:
        for portion in _portions(list(runs), 40 * TOGETHER):
            ids = np.frombuffer(b"".join(portion), IDS)
            self.database.register("runs", _rows(portion, 4, ids, "run"))
            bodies = self.database.sql(_DECODE).to_arrow_table()["body"].to_pylist()
            self.database.unregister("runs")
            self.update(zip(portion, bodies, strict=True))


def _slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` has some ``SLICE`` bytes, a longer value being alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        portions = np.cumsum(sizes, dtype=np.int64) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(portions)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                yield batch.slice(start, end - start)


def _forget(known: dict) -> None:
    """Keep what a task remembers within its bound; what a slice adds is bounded by its bytes."""
    if len(known) > REMEMBERED:
        known.clear()


def _looked_up(rows: list[list], known: _Words | _Runs) -> list[bytes]:
    """What ``known`` has for the items of each row, joined; items it lacks are learned first."""
    found = [list(map(known.get, items)) for items in rows]
    lacking = [k for k, values in enumerate(found) if None in values]
    known.learn({item for k in lacking for item, value in zip(rows[k], found[k]) if value is None})
    for k in lacking:
        found[k] = [known[item] if value is None else value for item, value in zip(rows[k], found[k])]
    return [b"".join(values) for values in found]


def _replaced(batch: pa.RecordBatch, column: str, name: str, values: list[bytes]) -> pa.RecordBatch:
    at = batch.schema.get_field_index(column)
    columns = [*batch.columns[:at], *batch.columns[at + 1 :], pa.array(values, pa.binary())]
    names = [*batch.schema.names[:at], *batch.schema.names[at + 1 :], name]
    return pa.RecordBatch.from_arrays(columns, names)


def encoded(
    batches: Iterable[pa.RecordBatch], path: str, pattern: str, column: str = "text", name: str = "ids"
) -> Iterator[pa.RecordBatch]:
    """Batches with ``ids``, little-endian unsigned 32-bit, in place of ``text``."""
    vocabulary = Vocabulary.of(path)
    # Blanks are the Unicode property, as for the tiktoken library; here \s would have more.
    blanks = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    find = regex.compile(blanks).findall
    with _database({"merges": vocabulary.merges}) as database:
        known = _Words(vocabulary, database)
        for batch in _slices(batches, column):
            _forget(known)
            texts = [find(text or "") for text in batch.column(column).to_pylist()]
            yield _replaced(batch, column, name, _looked_up(texts, known))


def decoded(
    batches: Iterable[pa.RecordBatch], path: str, column: str = "ids", name: str = "body"
) -> Iterator[pa.RecordBatch]:
    """Batches with ``body``, the bytes that the ids stand for, in place of ``ids``."""
    vocabulary = Vocabulary.of(path)
    with _database({"vocabulary": vocabulary.spelled}) as database:
        known = _Runs(database)
        for batch in _slices(batches, column):
            _forget(known)
            held = [_cut(ids or b"", vocabulary) for ids in batch.column(column).to_pylist()]
            yield _replaced(batch, column, name, _looked_up(held, known))


def _cut(ids: bytes, vocabulary: Vocabulary) -> list[bytes]:
    """Runs of ids that start with a token that leads with a blank, or with the first token."""
    numbers = np.frombuffer(ids, IDS)
    if len(numbers) and not (numbers.max() < len(vocabulary.given) and vocabulary.given[numbers].all()):
        raise ValueError("an id that the vocabulary lacks")
    starts = np.flatnonzero(vocabulary.leads[numbers])
    cuts = [0, *(4 * starts[starts > 0]).tolist(), len(ids)]
    return [ids[start:end] for start, end in zip(cuts, cuts[1:]) if start < end]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) of every row's text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(lambda batches: encoded(batches, path, pattern), "doc_id long, ids binary")
    return rows.select("doc_id", _tokens().alias("n_tokens"), "ids")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and body (binary) of rows with ``ids`` as :func:`encode` gives them."""
    held = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("binary").alias("ids"))
    return held.mapInArrow(lambda batches: decoded(batches, path), "doc_id long, body binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids and the ``body`` they decode to, in one pass over the texts."""

    def twice(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("again", batch.column("ids"))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(
        lambda batches: decoded(twice(encoded(batches, path, pattern)), path, "again"),
        "doc_id long, ids binary, body binary",
    )
    return rows.select("doc_id", _tokens().alias("n_tokens"), "ids", "body")


def _tokens() -> Column:
    return (F.octet_length("ids") / 4).cast("long")
