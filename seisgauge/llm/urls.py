"""URL filter: path rules, then a list of canonical URLs behind a blocked Bloom filter.

The listed URLs are hashed into 512-bit blocks of eight 64-bit lanes; a URL sets one bit in each
lane of one block. A page is a possible hit if its block holds all its eight bits. Only possible
hits meet the list itself, in an exact hash join that removes the false positives, so the other
pages are never shuffled.

Nulls and odd rows: a null URL or one without ``://`` has an empty host and path, fits no rule
and is never listed, so it is allowed. Repeated pages are judged one by one. An empty list or an
empty table of pages works. Extra columns are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

LANES = 8
#: 512 bits for 32 URLs: about 0.06 % false positives.
URLS_PER_BLOCK = 32
#: A filter of at most so many blocks (4 MiB of bits) is broadcast; a larger one is joined by
#: block number, which gives the same rows.
BROADCAST_BLOCKS = 1 << 16


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    from there to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def canonical(url: Column) -> Column:
    """The page behind a URL: no scheme, ``www.``, fragment, ``utm_`` parameters, ``.html`` or
    final slash. Null if the URL has no ``://``."""
    host, path = host_and_path(url)
    path = F.regexp_replace(path, r"(/|[.]html?)$", "")
    query = F.regexp_extract(url, r"^[^?#]*[?]([^#]*)", 1)
    query = F.regexp_replace(query, r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&", "")
    whole = F.concat(
        F.regexp_replace(host, r"^www[.]", ""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    return F.when(F.instr(url, "://") > 0, whole)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # later ones win
        here = fits(rule, host, path)
        text = F.when(here, F.lit(rule.text)).otherwise(text)
        verdict = F.when(here, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    spots = F.xxhash64(key)
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.shiftrightunsigned(spots, 6 * lane).bitwiseAND(F.lit(63)).cast("int"),
        )
        for lane in range(LANES)
    ]


def blocked_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block in use: ``block`` and its lanes. Bits are combined in each task first."""
    marked = keys.select(
        _block(F.col("key"), blocks).alias("block"),
        *(bit.alias(f"lane{lane}") for lane, bit in enumerate(_bits(F.col("key")))),
    )
    return marked.groupBy("block").agg(
        *(F.bit_or(f"lane{lane}").alias(f"lane{lane}") for lane in range(LANES))
    )


def possible_hits(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (with ``key``) and ``possible``: whether the filter may hold the key."""
    spots = rows.withColumn("block", _block(F.col("key"), blocks))
    side = F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom
    held = F.lit(True)
    for lane, bit in enumerate(_bits(F.col("key"))):
        held = held & (F.col(f"lane{lane}").bitwiseAND(bit) != 0)
    return (
        spots.join(side, "block", "left")
        .withColumn("possible", F.coalesce(held & F.col("key").isNotNull(), F.lit(False)))
        .drop("block", *(f"lane{lane}" for lane in range(LANES)))
    )


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: list[Rule]) -> DataFrame:
    """A row per page: page_id, host, path, rule, listed, verdict.

    The verdict is that of the longest rule that fits; without one, a listed page is blocked and
    any other is allowed. ``listed`` has a column ``url``.
    """
    keys = stage(
        listed.select(canonical(F.col("url").cast("string")).alias("key"))
        .where(F.col("key").isNotNull())
        .distinct(),
        "listed",
    )
    blocks = max(1, -(-keys.count() // URLS_PER_BLOCK))
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        canonical(url).alias("key"),
    )
    tested = possible_hits(rows, blocked_filter(keys, blocks), blocks)
    exact = keys.withColumn("listed", F.lit(True))
    hits = tested.where("possible").join(exact.hint("shuffle_hash"), "key", "left")
    passed = tested.where("not possible").withColumn("listed", F.lit(False))
    judged = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(passed)
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", text.alias("rule"),
        F.coalesce(verdict, by_list).alias("verdict"), "listed",
    )
