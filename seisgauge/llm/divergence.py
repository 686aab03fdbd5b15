"""Audit of how sources differ in their words, language by language.

The terms of a text are counted by source and language. A language keeps the terms of enough of its
documents. Every source, and the language as a whole, gives each kept term a smoothed share, a whole
number of billionths. Sources are compared in pairs by the sum of the differences of their shares,
and each source with its language by the terms it uses more.

Pairs are priced by a sparse merge. The kept terms of a language are dealt into blocks by a hash and
numbered within their block. A source has one array of (term id, count) for each block, sorted by
id and no longer than a block. Sources are gathered in tiles; a task takes one block of two tiles and
merges the two arrays of each unordered pair: a galloping search finds the terms both use, the rest
are one-sided, all other terms of the block are absent in both and count once for all of them. Both
directions of a pair have the same value. The values of the blocks are added up. No task holds more
than two tiles of block-long arrays, and an array is copied once for each tile of its language.

Counts are added up in each task before they are shuffled by (language, source, term), so a source
or a term with a third of everything is a row a task. The arithmetic is exact: shares are made by a
long division of whole numbers that holds for counts below 9 * 10^15 in a source.

Odd rows: null text, language and source are the empty text. A document is a row; repeated rows
count again. Sources without terms, and languages without kept terms, are compared all the same. A
language of one source has no pairs. Columns other than the three are left behind.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

# Shares are billionths, and 5 is added to each count.
SHARES, ADDED = 1_000_000_000, 5
#: Documents of a language that a term must be in.
LEAST_DOCUMENTS = 30
#: Terms listed for each source.
LISTED = 50
#: Terms of a block, on average, and sources of a tile.
BLOCK, TILE = 32_768, 8
#: Entries a task counts before it hands them on, and bytes of a text that are counted at a time.
HELD, PORTION = 300_000, 1_000_000

# ASCII letters, in lower case, and all bytes of other characters are of terms.
_TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32 for byte in range(256)
)
_COUNTED = "lang string, source string, term binary, n long, docs long"
_PRICED = "lang string, one string, other string, value long"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows it is in); a null term counts the rows."""
    rows = docs.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")],
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return (
        rows.mapInArrow(_counted, _COUNTED)
        .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, listed: int = LISTED) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts = stage(term_counts(docs), "term-counts")
    kept = stage(_kept_terms(counts, least_documents), "kept-terms")
    uses = stage(
        counts.where(F.col("term").isNotNull()).join(kept, ["lang", "term"]).drop("docs"), "kept-uses"
    )
    groups = _groups(counts, kept, uses)
    return _pairs(groups, kept, uses).unionByName(_terms(groups, uses, listed))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task by language, source and term, handed on before they grow too many."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    rows: Counter = Counter()
    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(name) for name in ("lang", "source", "text"))):
            group = lang.as_py(), source.as_py()
            rows[group] += 1
            own = _terms_of(text.as_buffer())
            n, docs = found[group]
            held -= len(n)
            n.update(own)
            docs.update(own.keys())
            held += len(n)
            if held > HELD:
                yield from _handed_on(found)
                found.clear()
                held = 0
    yield from _handed_on(found)
    groups = [(lang, source, None, n, n) for (lang, source), n in rows.items()]
    yield _batch(groups)


def _terms_of(text: pa.Buffer) -> Counter:
    """The terms of a text, cut into portions where it has a blank."""
    body = memoryview(text)
    if len(body) <= PORTION:
        return Counter(bytes(body).translate(_TERM_BYTES).split())
    own: Counter = Counter()
    rest = b""
    for start in range(0, len(body), PORTION):
        portion = rest + bytes(body[start : start + PORTION]).translate(_TERM_BYTES)
        whole, _, rest = portion.rpartition(b" ")
        own.update(whole.split())
    own.update(rest.split())
    return own


def _handed_on(found: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in found.items():
        yield _batch([(lang, source, term, count, docs[term]) for term, count in n.items()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = {"lang": pa.string(), "source": pa.string(), "term": pa.binary(), "n": pa.int64(), "docs": pa.int64()}
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds.values())]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _kept_terms(counts: DataFrame, least_documents: int) -> DataFrame:
    """lang, term, block, id (from 0 in its block), total (occurrences in the language)."""
    terms = (
        counts.where(F.col("term").isNotNull())
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
        .where(F.col("docs") >= least_documents)
    )
    blocks = terms.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    return (
        terms.join(blocks, "lang")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
        # By block, too: the join's partitioning by language would do for the window.
        .repartition("lang", "block")
        .select("lang", "term", "block", (F.row_number().over(in_block) - 1).alias("id"), "total")
    )


def _groups(counts: DataFrame, kept: DataFrame, uses: DataFrame) -> DataFrame:
    """lang, source, own (kept occurrences), v and all_own (terms and occurrences of the language),
    blocks, tile and tiles."""
    own = uses.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    totals = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("total").alias("all_own"), F.max("block").alias("last_block")
    )
    by_source = Window.partitionBy("lang").orderBy("source")
    everywhere = Window.partitionBy("lang")
    zero = F.lit(0)
    return (
        counts.where(F.col("term").isNull())
        .select("lang", "source")
        .withColumn("tile", F.floor((F.row_number().over(by_source) - 1) / TILE).cast("int"))
        .withColumn("tiles", F.max("tile").over(everywhere) + 1)
        .join(own, ["lang", "source"], "left")
        .join(totals, "lang", "left")
        .select(
            "lang",
            "source",
            "tile",
            "tiles",
            F.coalesce("own", zero).alias("own"),
            F.coalesce("v", zero).alias("v"),
            F.coalesce("all_own", zero).alias("all_own"),
            (F.coalesce("last_block", zero) + 1).alias("blocks"),
        )
    )


def _pairs(groups: DataFrame, kept: DataFrame, uses: DataFrame) -> DataFrame:
    arrays = uses.groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries")
    )
    sizes = kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
    # Sources without a term of a block take part in it all the same.
    complete = (
        groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(sizes, ["lang", "block"], "left")
        .join(arrays, ["lang", "source", "block"], "left")
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang",
            "block",
            F.least("tile", "mate").alias("low_tile"),
            F.greatest("tile", "mate").alias("high_tile"),
            "tile",
            "source",
            (F.col("own") + ADDED * F.col("v")).alias("whole"),
            F.coalesce("size", F.lit(0)).alias("size"),
            F.col("entries.id").alias("ids"),
            F.col("entries.n").alias("counts"),
        )
    )
    priced = (
        complete.groupBy("lang", "block", "low_tile", "high_tile")
        .applyInArrow(_priced, _PRICED)
        .groupBy("lang", "one", "other")
        .agg(F.sum("value").alias("value"))
    )
    both = priced.select(
        "lang",
        F.explode(
            F.array(
                F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                F.struct(F.col("other").alias("source"), F.col("one").alias("item")),
            )
        ).alias("way"),
        "value",
    ).select("lang", "way.source", "way.item", "value")
    return _ranked(both, "pair")


def _terms(groups: DataFrame, uses: DataFrame, listed: int) -> DataFrame:
    def share(n: str, whole: str) -> Column:
        return F.expr(f"1 + ({SHARES} * cast({n} + {ADDED} as decimal(20,0))) div ({whole} + {ADDED} * v)")

    more = (
        uses.join(groups.select("lang", "source", "own", "v", "all_own"), ["lang", "source"])
        .where("n > 0")
        .select(
            "lang",
            "source",
            F.col("term").alias("item"),
            (share("n", "own") - share("total", "all_own")).cast("long").alias("value"),
        )
        .where("value > 0")
    )
    return _ranked(more, "term", listed)


def _ranked(rows: DataFrame, part: str, listed: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if listed is not None:
        ranked = ranked.where(F.col("rank") <= listed)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _priced(table: pa.Table) -> pa.Table:
    """The value of each unordered pair of a source of the lower tile and one of the higher."""
    table = table.combine_chunks()
    held = []
    for row in range(table.num_rows):
        ids, counts = (_numbers(table.column(name)[row]) for name in ("ids", "counts"))
        whole = table.column("whole")[row].as_py()
        shares = _shares(np.append(counts, 0), whole)
        held.append(
            (table.column("source")[row].as_py(), table.column("tile")[row].as_py(), ids, shares[:-1], shares[-1])
        )
    one_tile = table.column("low_tile")[0] == table.column("high_tile")[0]
    low = table.column("low_tile")[0].as_py()
    size = table.column("size")[0].as_py()
    lang = table.column("lang")[0].as_py()
    found = []
    for k, left in enumerate(held):
        for right in held[k + 1 :]:
            if one_tile or (left[1] == low) != (right[1] == low):
                one, other = sorted((left[0], right[0]), key=str.encode)
                found.append((lang, one, other, _merged(left[2:], right[2:], size)))
    columns = list(zip(*found)) or [()] * 4
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["lang", "one", "other", "value"]
    )


def _numbers(held: pa.ListScalar) -> np.ndarray:
    values = held.values
    return np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False).astype(np.int64)


def _shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(SHARES * (count + ADDED) / whole), by long division in steps of a thousand."""
    if whole == 0:
        return np.zeros(len(counts), np.int64)
    quotient, rest = np.divmod(counts + ADDED, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digits
    return 1 + quotient


def _merged(left: tuple, right: tuple, size: int) -> int:
    """Sum of the differences of two sources' shares over the terms of a block."""
    if len(left[0]) > len(right[0]):
        left, right = right, left
    (ids, shares, rest), (far_ids, far_shares, far_rest) = left, right
    places = gallop(ids, far_ids)
    inside = places < len(far_ids)
    inside[inside] = far_ids[places[inside]] == ids[inside]
    met = places[inside]
    alone = np.ones(len(far_ids), bool)
    alone[met] = False
    both = np.abs(shares[inside] - far_shares[met]).sum()
    here = np.abs(shares[~inside] - far_rest).sum()
    there = np.abs(far_shares[alone] - rest).sum()
    absent = (size - len(ids) - len(far_ids) + len(met)) * abs(int(rest) - int(far_rest))
    return int(both) + int(here) + int(there) + absent


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 64) -> np.ndarray:
    """For each of the sorted ``short`` the place of the first of ``long`` that isn't less.

    From where the last few ended, steps of doubled length pass the next few; between the last two
    steps they are found by halving.
    """
    places = np.empty(len(short), np.int64)
    at = 0
    for start in range(0, len(short), stride):
        few = short[start : start + stride]
        step = stride
        while at + step < len(long) and long[at + step] < few[-1]:
            step *= 2
        places[start : start + len(few)] = at + np.searchsorted(long[at : at + step + 1], few)
        at = int(places[start + len(few) - 1])
    return places
