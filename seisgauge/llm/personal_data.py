"""Personal data: patterns propose spans, validators confirm them, nearby words adjust the score.

A kind's pattern splits the text into the pieces between its matches; the lengths of pieces and
matches give the places. A validator then drops matches: Luhn for card numbers, mod-97 for
account numbers (IBAN), ranges and digit counts for the rest. A context word in the 40 characters
before or the 20 after raises the score, and spans below ``LEAST_SCORE`` are left out. That decides
over what digits alone can't tell: three groups like ``123-45-6789`` (``ssn``) count only near a word
that says so. The other kinds reach the score by themselves.

Places are running sums of lengths, kept in blocks of ``STEPS`` numbers so that no list is copied
for each span, and replaced texts are put together from chunks; a text may hold any number of spans.

The patterns never step back over a long run: runs are possessive, and a run is tried from its
first character or from the end of the match before only, which finds the same leftmost matches.

Places are code points from 0, ends exclusive. Only built-in functions work here.

Nulls and odd rows: a null or empty text has no spans. Repeated rows are judged one by one. A text
of any length works; kinds whose marks (``@``, ``+``, digits) are missing cost no pattern run.
Extra columns are left behind by ``find_spans`` and kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .inputs import texts

BEFORE, AFTER = 40, 20
CONTEXT_BONUS = 0.2
LEAST_SCORE = 0.5
#: Numbers in a block of running sums, and code points in a chunk of text.
STEPS, CHUNK = 256, 512


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _symbols(text: Column) -> Column:
    """The characters of a short text."""
    return F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1))
    )


def luhn(match: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""
    digits = _digits(match)

    def weighed(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed),
        F.lit(0),
        lambda held, value: held + value,
    )
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def mod97(match: Column) -> Column:
    """The first four characters moved to the end and letters read as 10 to 35: 1 modulo 97."""
    turned = F.concat(F.substring(match, F.lit(5), F.length(match)), F.substring(match, 1, 4))

    def step(held: Column, symbol: Column) -> Column:
        letter = symbol.rlike("[A-Z]")
        value = F.when(letter, F.ascii(symbol) - 55).otherwise(F.ascii(symbol) - 48)
        return (held * F.when(letter, 100).otherwise(10) + value) % 97

    return F.aggregate(_symbols(turned), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """``mark``: what a text must hold for the pattern to be run. ``alone``: no letter or digit
    may stand next to the match."""

    name: str
    pattern: str
    mark: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    words: str
    score: float
    alone: bool = False


def _has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


def _small_parts(match: Column) -> Column:
    # Longer than nine digits is above 255 unless it starts with zeros.
    parts = F.transform(F.split(match, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(
        parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False))
    )


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")),
        lambda match: F.lit(True),
        "mail|contact|write|address",
        0.8,
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        lambda text: text.rlike(r"[0-9]\.[0-9]"),
        _small_parts,
        "ip|host|server|address|from",
        0.6,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        _has_digit,
        luhn,
        "card|visa|credit|pay",
        0.7,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda text: F.contains(text, F.lit("+")),
        lambda match: F.length(_digits(match)).between(9, 15),
        "phone|tel|call|fax|mobile",
        0.7,
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
        _has_digit,
        mod97,
        "iban|account|bank|transfer",
        0.8,
        alone=True,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda text: text.rlike("[0-9]-[0-9]"),
        lambda match: ~match.rlike("^(000|666|9)|-00-|-0000$"),
        "ssn|social|taxpayer",
        0.4,
        alone=True,
    ),
)
BASE = ("email", "ip", "card", "phone")


def _proposals(kind: Kind, text: Column) -> tuple[Column, Column]:
    """The matches and the pieces around them, one more than matches."""
    marked = kind.mark(text)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    none = F.array().cast("array<string>")
    return F.when(marked, matches).otherwise(none), F.when(marked, pieces).otherwise(none)


def _scanned(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """All numbers up to each place combined, of a short list."""

    def step(held: Column, number: Column) -> Column:
        last = F.get(held, F.size(held) - 1)
        return F.array_append(held, F.when(last.isNull(), number).otherwise(combine(last, number)))

    return F.aggregate(numbers, F.array().cast("array<bigint>"), step)


def _with_scan(
    rows: DataFrame, columns: dict[str, str], combine: Callable[[Column, Column], Column]
) -> DataFrame:
    """``rows`` with, by name, the scan of another column's longs. Blocks are scanned first, then
    their last values, which every later block takes in."""
    blocks, scans = {}, {}
    for name, source in columns.items():
        numbers = F.col(source)
        count = F.ceil(F.size(numbers) / STEPS).cast("int")
        each = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda k: _scanned(F.slice(numbers, k * STEPS + 1, F.lit(STEPS)), combine),  # noqa: B023
        )
        none = F.array().cast("array<array<bigint>>")
        blocks[f"{name}_blocks"] = F.when(F.size(numbers) > 0, each).otherwise(none)
        held = F.col(f"{name}_blocks")
        before = F.concat(
            F.array(F.lit(None).cast("long")),
            _scanned(F.transform(held, lambda block: F.element_at(block, -1)), combine),
        )

        def shifted(block: Column, most: Column) -> Column:
            return F.transform(block, lambda x: F.when(most.isNull(), x).otherwise(combine(most, x)))

        scans[name] = F.flatten(
            F.zip_with(held, F.slice(before, F.lit(1), F.size(held)), shifted)
        )
    return rows.withColumns(blocks).withColumns(scans).drop(*blocks)


def _lengths(kind: Kind) -> Column:
    """The length of each match and the piece before it."""
    matches, pieces = F.col(f"_{kind.name}"), F.col(f"_{kind.name}_pieces")
    return F.transform(matches, lambda m, i: (F.length(pieces[i]) + F.length(m)).cast("long"))


def _placed(kind: Kind) -> Column:
    """Matches with place and surroundings, from the columns of ``_proposals`` and the ends."""
    matches, pieces, ends = (F.col(f"_{kind.name}{part}") for part in ("", "_pieces", "_ends"))

    def place(match: Column, i: Column) -> Column:
        return F.struct(
            (ends[i] - F.length(match)).alias("start"),
            ends[i].alias("end"),
            match.alias("match"),
            F.right(pieces[i], F.lit(BEFORE)).alias("before"),
            F.left(pieces[i + 1], F.lit(AFTER)).alias("after"),
        )

    return F.transform(matches, place)


def _confirmed(kind: Kind) -> Column:
    def holds(x: Column) -> Column:
        valid = kind.valid(x["match"])
        if kind.alone:
            valid = valid & ~x["before"].rlike("[A-Za-z0-9]$") & ~x["after"].rlike("^[A-Za-z0-9]")
        return valid

    def scored(x: Column) -> Column:
        near = F.lower(F.concat_ws(" ", x["before"], x["after"])).rlike(kind.words)
        score = F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            score.alias("score"),
        )

    found = F.transform(F.filter(F.col(f"_{kind.name}_placed"), holds), scored)
    return F.coalesce(found, F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>"))


def with_spans(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, least_score: float = LEAST_SCORE
) -> DataFrame:
    """``docs`` (with a ``text`` that isn't null) and ``spans`` of at least this score, kind by kind
    in the order given, then by start. Each step is a column of its own, so that no pattern runs
    twice."""
    columns: dict[str, Column] = {}
    for kind in kinds:
        columns[f"_{kind.name}"], columns[f"_{kind.name}_pieces"] = _proposals(kind, F.col("text"))
    lengths = {f"_{kind.name}_lengths": _lengths(kind) for kind in kinds}
    ends = {f"_{kind.name}_ends": f"_{kind.name}_lengths" for kind in kinds}
    placed = {f"_{kind.name}_placed": _placed(kind) for kind in kinds}
    spans = F.filter(
        F.concat(*(_confirmed(kind) for kind in kinds)), lambda s: s["score"] >= least_score
    )
    rows = docs.withColumns(columns).withColumns(lengths)
    return (
        _with_scan(rows, ends, lambda held, length: held + length)
        .withColumns(placed)
        .drop(*columns, *lengths, *ends)
        .withColumn("spans", spans)
        .drop(*placed)
    )


def find_spans(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, least_score: float = LEAST_SCORE
) -> DataFrame:
    """A row per document: doc_id and spans (kind, start, end, score)."""
    return with_spans(texts(docs), kinds, least_score).select("doc_id", "spans")


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` from its chunks of ``CHUNK`` code points."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    head, tail = (start % CHUNK).cast("int"), (end % CHUNK).cast("int")
    within = F.substring(F.coalesce(F.get(chunks, first), F.lit("")), head + 1, (end - start).cast("int"))
    across = F.concat(
        F.substring(F.get(chunks, first), head + 1, F.lit(CHUNK)),
        F.array_join(F.slice(chunks, first + 2, last - first - 1), ""),
        F.left(F.coalesce(F.get(chunks, last), F.lit("")), tail),
    )
    return F.when(first == last, within).otherwise(across)


def redact(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with each span of at least this score replaced by ``[KIND]``. Spans that overlap
    give way to the one that starts first, but what any of them covers goes. A null text stays."""
    text, taken, reach = F.col("text"), F.col("_taken"), F.col("_reach")
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))

    def part(span: Column, i: Column) -> Column:
        at = F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0).cast("long"))
        label = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        # A span that starts inside what went before it leaves nothing of its own.
        return F.when(
            span["start"] >= at, F.concat(_cut(F.col("_chunks"), at, span["start"]), label)
        ).otherwise("")

    rest = _cut(F.col("_chunks"), F.element_at(reach, -1), F.length(text).cast("long"))
    clean = F.concat(F.array_join(F.transform(taken, part), ""), rest)
    kept = docs.withColumn("_given", text).withColumn("text", F.coalesce(text, F.lit("")))
    spans = (
        with_spans(kept, least_score=least_score)
        .withColumn("_taken", ordered)
        .withColumn("_stops", F.transform(taken, lambda s: s["end"]))
        .withColumn("_chunks", F.when(F.size(taken) > 0, chunks))
    )
    return (
        _with_scan(spans, {"_reach": "_stops"}, F.greatest)
        .withColumn("text", F.when(F.size(taken) > 0, clean).otherwise(F.col("_given")))
        .select(*docs.columns)
    )
