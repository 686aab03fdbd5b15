"""Near duplicates: MinHash with tensored banding, verified on the full sets.

Each document has three collections of ``SUBS`` small sketches, of two minhashes each. A table's
key combines a sketch of the first collection with one of the second, so ``SUBS`` squared tables of
four minhashes cost only four times ``SUBS`` of them. Two sets of similarity s share a table unless
they differ in all sketches of a collection: at s = 0.8 that is about 1 in 100 000.

Documents of equal sets are one class, named by its least doc_id; only classes are compared.

1. Sketches of the first collection that no other class has are dropped before they meet the
   second, and so are keys of one class. So most classes never make keys.
2. In each bucket every class is compared with the least one (a star, not all pairs). Confirmed
   links join classes to components.
3. Buckets that still hold several components are looked at again. Where few classes (``FEW``) are
   outside the largest component, these are compared with the rest of the bucket, pair by pair; with
   more of them it takes fewer texts to send each class of the bucket once. Other buckets whose keys
   begin with the same sketch of the first collection go to one task together, if they hold
   ``GATHERED`` classes at most, or else each on its own; the task compares those of different
   components and gives the links that join them. Larger ones are split by sketches of the third
   collection, again and again; after ``LEVELS`` splits what is left is compared across components
   whatever its size. No bucket is cut off.

Candidates pass a test of sizes, which is exact, and of 128 bits of the sketches, which lets a pair
of similarity 0.8 go less than once in a million times. Then whole texts are compared: a task holds
the shingles of one class and streams those to compare with it. A class with many partners is dealt
over several tasks.

Words are lower-cased A-Z and shingles compared by 64-bit hashes.

Nulls and odd rows: a null or blank text has no shingles and is linked with nothing. Fewer words
than a shingle are one shingle. Repeated rows are in one class; rows that share a doc_id but not
their text count as linked: their classes are linked, and classes of one name are compared by all of
their texts. A null doc_id is passed over: its row is kept and has no component.
An empty table works. Extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

from .components import components
from .inputs import texts
from .memory import forgetting
from .word_hashes import run_hashes, word_hashes

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE, SIMILARITY = 5, 80
#: Sketches of a collection.
SUBS = 12
FEW, GATHERED, LEVELS = 4, 2000, 6
#: Bits of 128 in which the sketches of a linked pair may differ: 12.8 are expected.
FAR_BITS = 37
#: Partners of a class that a task compares.
PARTNERS = 500

_chance = np.random.default_rng(20)
_FACTORS = _chance.integers(1, 1 << 63, 6 * SUBS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _chance.integers(0, 1 << 63, 6 * SUBS, dtype=np.uint64)
_CHUNK = 4096

SKETCH_SCHEMA = (
    "doc_id long, n_shingles long, set_key binary, bits0 long, bits1 long, "
    "a array<long>, b array<long>, c array<long>"
)
EDGE_SCHEMA = "u long, v long"


def shingles(text: str, length: int) -> np.ndarray:
    """Distinct shingles as sorted hashes."""
    words = text.encode().lower().split()
    return np.unique(run_hashes(word_hashes(words), min(length, len(words)) or 1))


def minhashes(held: np.ndarray) -> np.ndarray:
    least = np.full(_FACTORS.size, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, held.size, _CHUNK):
        part = held[at : at + _CHUNK, None] * _FACTORS + _ADDENDS
        np.minimum(least, part.min(0), out=least)
    return least


def _sketches(docs: DataFrame, length: int) -> DataFrame:
    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, found = [], [], []
            for text in batch.column("text"):
                held = shingles(text.as_py(), length)
                sizes.append(held.size)
                keys.append(xxhash.xxh3_128_digest(held.tobytes()) if held.size else None)
                found.append(minhashes(held))
            least = np.array(found, np.uint64).reshape(-1, _FACTORS.size)
            pairs = run_pairs(least)
            # Two bits of each of 64 minhashes.
            bits = [
                (((least[:, :64] >> np.uint64(shift)) & np.uint64(1)) << np.arange(64, dtype=np.uint64))
                .sum(1, dtype=np.uint64).view(np.int64)
                for shift in (40, 41)
            ]
            collections = [
                pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), SUBS).cast(pa.list_(pa.int64()))
                for part in np.split(pairs, 3, axis=1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *map(pa.array, bits), *collections],
                names=["doc_id", "n_shingles", "set_key", "bits0", "bits1", "a", "b", "c"],
            )

    return texts(docs).mapInArrow(run, SKETCH_SCHEMA)


def run_pairs(least: np.ndarray) -> np.ndarray:
    """A sketch of each two minhashes."""
    held = least[:, 0::2] * _FACTORS[0] + least[:, 1::2]
    return (held ^ (held >> np.uint64(31))).view(np.int64)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, node) of keys that several nodes have, with the least node of each."""
    held = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("_most"))
    return rows.join(held.where("least < _most").drop("_most"), "key")


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, first, node, least) of the tables' buckets that hold several classes; ``first`` is
    the part of the key from the first collection."""
    first = classes.select("node", F.posexplode("a").alias("i", "sketch")).select(
        "node", F.xxhash64("i", "sketch").alias("key")
    )
    # At most SUBS keys for each class.
    used = _shared(first).groupBy("node").agg(F.collect_set("key").alias("firsts"))
    tables = (
        used.join(classes.select("node", "b"), "node")
        .select("node", "b", F.explode("firsts").alias("first"))
        .select("node", "first", F.posexplode("b").alias("i", "sketch"))
        .select("node", "first", F.xxhash64("first", "i", "sketch").alias("key"))
        .distinct()
    )
    return _shared(tables)


def _candidates(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (center, node) that sizes and bits allow."""
    small = classes.select("node", "n_shingles", "bits0", "bits1")
    of = lambda name: small.select(*(F.col(c).alias(f"{name}_{c}") for c in small.columns))
    both = (
        pairs.select("center", "node").distinct()
        .join(of("l"), F.col("center") == F.col("l_node"))
        .join(of("r"), F.col("node") == F.col("r_node"))
    )
    n, m = F.col("l_n_shingles"), F.col("r_n_shingles")
    apart = sum(
        F.bit_count(F.col(f"l_{b}").bitwiseXOR(F.col(f"r_{b}"))) for b in ("bits0", "bits1")
    )
    fits = (100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)) & (apart <= FAR_BITS)
    return both.where(fits).select("center", "node").distinct()


def _confirmed(pairs: DataFrame, bodies: DataFrame, length: int, percent: int) -> DataFrame:
    """Links (u, v): the pairs (center, node) whose full sets are similar enough."""
    shares = pairs.groupBy("center").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("node", "center"), F.col("shares")).cast("int").alias("share")
    members = pairs.join(shares, "center").select("center", share, "node")
    heads = shares.select(
        "center", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("center").alias("node")
    )
    wanted = members.unionByName(heads)
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        wanted.join(bodies, "node")
        .repartition(parts, "center", "share")
        # The head of a share comes first; a class has the same text wherever it stands.
        .sortWithinPartitions("center", "share", F.col("node") != F.col("center"))
    )

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in batches:
            found = []
            for center, share, node, text in zip(
                *(batch.column(c).to_pylist() for c in ("center", "share", "node")), batch.column("text")
            ):
                held = shingles(text.as_py(), length)
                if node == center:
                    # Further texts of the same id count as linked without a look.
                    if at != (center, share):
                        at, heads = (center, share), []
                    if not any(np.array_equal(held, head) for head in heads):
                        heads.append(held)
                elif at == (center, share) and any(_alike(head, held, percent) for head in heads):
                    found.append((center, node))
            u, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

    return rows.select("center", "share", "node", "text").mapInArrow(run, EDGE_SCHEMA)


def _alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    same = np.intersect1d(one, other, assume_unique=True).size
    return 100 * same >= percent * (one.size + other.size - same)


def _of_one_id(named: DataFrame, least: DataFrame) -> DataFrame:
    """Links (u, v) between the classes that have a doc_id in common."""
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    held = named.select("doc_id", "set_key").join(repeated, "doc_id", "left_semi").join(least, "set_key")
    first = held.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("_last"))
    both = held.join(first.where("v < _last"), "doc_id")
    return both.select(F.col("node").alias("u"), "v").where("u <> v").distinct()


def _labelled(rows: DataFrame, reached: DataFrame) -> DataFrame:
    """``rows`` with ``comp``: the component of the node so far."""
    comp = reached.select(F.col("u").alias("node"), F.col("v").alias("_v"))
    return rows.join(comp, "node", "left").withColumn("comp", F.coalesce("_v", "node")).drop("_v")


def _is_empty(rows: DataFrame) -> bool:
    return not rows.take(1)


def _open(buckets: DataFrame, reached: DataFrame) -> DataFrame:
    """(key, first, node, comp, total, main, others) of buckets with several components: the nodes, the
    largest component (the least of those) and how many nodes are outside it."""
    rows = _labelled(buckets.select("key", "first", "node"), reached)
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    held = sizes.groupBy("key").agg(
        F.max(F.struct(F.col("n"), (-F.col("comp")).alias("c"))).alias("top"), F.sum("n").alias("total")
    )
    several = held.where("top.n < total").select(
        "key", "total", (-F.col("top.c")).alias("main"), (F.col("total") - F.col("top.n")).alias("others")
    )
    return rows.join(several, "key")


def _across(held: DataFrame) -> DataFrame:
    """Pairs of nodes of different components of one bucket."""
    outside = held.where("comp <> main").select("key", F.col("node").alias("center"), F.col("comp").alias("_comp"))
    pairs = outside.join(held.select("key", "node", "comp"), "key").where("_comp <> comp")
    return pairs.select(F.greatest("center", "node").alias("node"), F.least("center", "node").alias("center"))


class Joined:
    """Components of a few nodes."""

    def __init__(self, comps: list[int]) -> None:
        first: dict[int, int] = {}
        self.up = [first.setdefault(comp, k) for k, comp in enumerate(comps)]

    def of(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, j: int, k: int) -> None:
        self.up[self.of(j)] = self.of(k)


def joining_links(
    nodes: list[int], comps: list[int], sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links between nodes of different components, as many as it takes to join all that are
    linked. Nodes are told apart by shingles in common, counted for one node at a time."""
    if not sets:
        return []
    sizes = np.array([held.size for held in sets], np.int64)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    owners, counts = owner[order], np.bincount(place, minlength=values.size)
    first = np.cumsum(counts) - counts
    begins = np.cumsum(sizes) - sizes
    joined, links = Joined(comps), []
    # Of each pair to compare one is outside the largest component.
    main = max(set(comps), key=comps.count)
    for j in [j for j in range(len(sets)) if comps[j] != main]:
        own = place[begins[j] : begins[j] + sizes[j]]
        spots = np.repeat(first[own] - np.cumsum(counts[own]) + counts[own], counts[own]) + np.arange(counts[own].sum())
        same = np.bincount(owners[spots], minlength=len(sets))
        for k in np.flatnonzero(100 * same >= percent * (sizes[j] + sizes - same)).tolist():
            if joined.of(j) != joined.of(k):
                joined.join(j, k)
                links.append((nodes[j], nodes[k]))
    return links


def _groups(hard: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, node, comp) of groups to gather, and the rows of buckets that are too large. A
    class is in as many groups as it has sketches in a collection, rather than in all tables."""
    members = hard.select("first", "node", "comp").distinct()
    small = members.groupBy("first").agg(F.count("*").alias("n")).where(F.col("n") <= GATHERED).select("first")
    together = members.join(small, "first").select(F.col("first").alias("key"), "node", "comp")
    rest = hard.join(small, "first", "left_anti")
    alone = rest.where(F.col("total") <= GATHERED).select("key", "node", "comp")
    return together.unionByName(alone), rest.where(F.col("total") > GATHERED)


def _gathered(held: DataFrame, bodies: DataFrame, length: int, percent: int) -> DataFrame:
    """Links within buckets of a bounded size, a bucket at a time."""
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        held.select("key", "node", "comp").join(bodies, "node")
        .repartition(parts, "key")
        .sortWithinPartitions("key", "node")
    )

    @forgetting
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, comps, sets = None, [], [], []

        def settle() -> pa.RecordBatch:
            u, v = zip(*found) if (found := joining_links(nodes, comps, sets, percent)) else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for key, node, comp, text in zip(
                *(batch.column(c).to_pylist() for c in ("key", "node", "comp")), batch.column("text")
            ):
                if key != at:
                    yield settle()
                    at, nodes, comps, sets = key, [], [], []
                nodes.append(node)
                comps.append(comp)
                sets.append(shingles(text.as_py(), length))
        yield settle()

    return rows.select("key", "node", "comp", "text").mapInArrow(run, EDGE_SCHEMA)


def _split(held: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """Buckets of longer keys: each goes on by two sketches of the third collection."""
    rows = held.select("key", "node").join(classes.select("node", "c"), "node")
    near = F.pmod(F.col("key"), F.lit(SUBS))
    spots = [F.pmod(near + 2 * level + k, F.lit(SUBS)).cast("int") for k in (0, 1)]
    longer = F.array(*(F.xxhash64("key", F.lit(k), F.col("c")[spots[k]]) for k in (0, 1)))
    split = rows.select("node", F.explode(longer).alias("key"))
    return _shared(split.withColumn("first", F.col("key")))


def near_duplicates(docs: DataFrame, length: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (the least doc_id reachable over links
    of at least ``percent`` hundredths), kept (whether that is the document itself)."""
    if percent < SIMILARITY:
        raise ValueError("the tables are made for a similarity of at least 0.8")
    sketches = stage(_sketches(docs, length), "sketches")
    named = sketches.where("doc_id is not null and n_shingles > 0")
    least = stage(named.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    classes = stage(
        named.withColumnRenamed("doc_id", "node").join(least, ["set_key", "node"])
        # Repeated rows of the least document are one.
        .dropDuplicates(["node", "set_key"])
        .select("node", "n_shingles", "bits0", "bits1", "a", "b", "c"),
        "class-sketches",
    )
    buckets = stage(_buckets(classes), "buckets")
    star = buckets.where("node <> least").select(F.col("least").alias("center"), "node")
    pairs = stage(_candidates(star, classes), "pairs")
    involved = buckets.select("node").distinct()
    bodies = stage(
        texts(docs).withColumnRenamed("doc_id", "node").join(involved, "node", "left_semi"), "texts"
    )
    links = stage(_confirmed(pairs, bodies, length, percent), "confirmed")
    tested, reached = pairs, components(links.unionByName(_of_one_id(named, least)))
    for level in range(LEVELS + 1):
        held = stage(_open(buckets, reached), "open")
        easy = held if level == LEVELS else held.where(F.col("others") <= FEW)
        fresh = _across(easy).distinct().join(tested, ["center", "node"], "left_anti")
        pairs = stage(_candidates(fresh, classes), "pairs")
        links = stage(_confirmed(pairs, bodies, length, percent), "confirmed")
        hard = held.where(F.col("others") > FEW)
        if level < LEVELS and not _is_empty(hard):
            groups, hard = _groups(hard)
            links = links.unionByName(stage(_gathered(groups, bodies, length, percent), "gathered"))
        reached = components(reached.unionByName(links))
        tested = tested.unionByName(pairs)
        if level == LEVELS or _is_empty(hard):
            break
        buckets = stage(_split(hard, classes, level), "buckets")
    comps = reached.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    component = F.coalesce("comp", "node", "doc_id")
    return (
        sketches.select("doc_id", "n_shingles", "set_key")
        .join(least, "set_key", "left")
        .join(comps, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
