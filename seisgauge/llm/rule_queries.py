"""Registered queries of the built-in operators over documents, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .inputs import documents
from .personal_data import AFTER, BASE, BEFORE, KINDS, find_spans
from .quality_rules import apply_policy, ledger, policy_mask

#: The policy that decides in the query.
POLICY = 2


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("failed_bits").bitwiseAND(F.lit(policy_mask(1)).cast("long")) != 0
    rows = apply_policy(ledger(documents(spark, sf_dir)), POLICY).withColumn("base_failed", base)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_bits",
    )


OP9_SQL = r"""
with given as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), split as (
    select r, doc_id, text,
        list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as held,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from given
), placed as (
    select r, unnest(range(len(held) - 4)) as i, held from split where len(held) >= 5
), windows as (
    select r, i, held[i + 1 : i + 5] as w from placed
), again as (
    select r, i from windows qualify count(*) over (partition by r, w) > 1
), covered as (
    select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2, i + 3, i + 4]) as p from again)
    group by r
), measured as (
    select doc_id, len(held)::bigint as n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n, 0)::bigint as n_repeat_words,
        len(lines) as n_lines,
        length(regexp_replace(text, '[^A-Z]+', '', 'g')) as n_capitals
    from split left join covered using (r)
), judged as (
    select *, (case when n_words < 10 then 1 else 0 end
        + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
        + case when 100 * n_symbols > 10 * n_words then 4 else 0 end
        + case when n_words > 0 and word_chars < 2 * n_words then 8 else 0 end
        + case when word_chars > 15 * n_words then 16 else 0 end
        + case when 100 * n_dup_lines > 50 * n_lines then 32 else 0 end
        + case when 100 * n_capitals > 30 * word_chars then 64 else 0 end)::bigint as failed_bits
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failed_bits & 3 <> 0 as base_failed, failed_bits = 0 as kept, failed_bits
from judged
"""


def _texts_of(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        found = F.filter(spans, lambda s: s["kind"] == kind)
        return F.size(found).cast("long").alias(f"n_{kind}")

    return find_spans(documents(spark, sf_dir)).select(
        "doc_id", *map(count, BASE), F.sha2(_texts_of(base), 256).alias("base_sha256"), _texts_of(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"),
    )


def _near(name: str) -> str:
    """SQL: whether a context word of a kind stands near a match."""
    words = {kind.name: kind.words for kind in KINDS}[name]
    return f"regexp_matches(lower(right(before, {BEFORE}) || ' ' || left(after, {AFTER})), '{words}')"


def _points(name: str) -> str:
    score = {kind.name: round(100 * kind.score) for kind in KINDS}[name]
    return f"{score} + case when {_near(name)} then 20 else 0 end as points"


def _places(kind: str, pattern: str) -> str:
    """SQL: matches of one kind with start and end."""
    return rf"""
    select r, '{kind}' as kind, m, s as start, s + length(m) as stop, before, after from (
        select r, ms[i] as m, ps[i] as before, ps[i + 1] as after,
            list_sum(list_transform(ps[1 : i], lambda p: length(p)))
            + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda p: length(p))), 0) as s
        from (
            select *, unnest(range(1, len(ms) + 1)) as i from (
                select r, regexp_extract_all(text, '{pattern}') as ms,
                    string_split_regex(text, '{pattern}') as ps
                from given
            )
        )
    )"""


OP3_SQL = rf"""
with given as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), email as ({_places('email', r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')}
), ip as ({_places('ip', r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)')}
), card as ({_places('card', r'[0-9](?:[\x20-]?[0-9])+')}
), phone as ({_places('phone', r'\+[0-9][\x20().0-9-]+[0-9]')}
), iban as ({_places('iban', r'[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}')}
), ssn as ({_places('ssn', r'[0-9]{3}-[0-9]{2}-[0-9]{4}')}
), digits as (
    select *, regexp_replace(m, '[^0-9]', '', 'g') as d from card
), turned as (
    select *, list_transform(string_split(m[5:] || m[1:4], ''),
        lambda c: case when c between 'A' and 'Z' then (ascii(c) - 55)::varchar else c end) as symbols
    from iban
    where not regexp_matches(before, '[A-Za-z0-9]$') and not regexp_matches(after, '^[A-Za-z0-9]')
), found as (
    select r, 1 as k, kind, start, stop, {_points('email')} from email
    union all
    select r, 2, kind, start, stop, {_points('ip')} from ip
    where list_bool_and(list_transform(string_split(m, '.'), lambda p: p::hugeint <= 255))
    union all
    select r, 3, kind, start, stop, {_points('card')} from digits
    where length(d) between 13 and 19 and list_sum(list_transform(range(length(d)), lambda i:
        case when i % 2 = 0 then d[length(d) - i]::int
        else d[length(d) - i]::int * 2 // 10 + d[length(d) - i]::int * 2 % 10 end)) % 10 = 0
    union all
    select r, 4, kind, start, stop, {_points('phone')} from phone
    where length(regexp_replace(m, '[^0-9]', '', 'g')) between 9 and 15
    union all
    select r, 5, kind, start, stop, {_points('iban')} from turned
    where list_reduce(list_transform(string_split(array_to_string(symbols, ''), ''), lambda c: c::int),
        lambda held, c: (held * 10 + c) % 97) = 1
    union all
    select r, 6, kind, start, stop, {_points('ssn')} from ssn
    where not regexp_matches(before, '[A-Za-z0-9]$') and not regexp_matches(after, '^[A-Za-z0-9]')
        and not regexp_matches(m, '^(000|666|9)|-00-|-0000$') and {_near('ssn')}
), told as (
    select r, count(*) filter (k = 1) as n1, count(*) filter (k = 2) as n2,
        count(*) filter (k = 3) as n3, count(*) filter (k = 4) as n4,
        string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by k, start) filter (k < 5) as base,
        string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by k, start) as spans,
        string_agg(points::varchar, ',' order by k, start) as scores
    from found group by r
)
select doc_id, coalesce(n1, 0) as n_email, coalesce(n2, 0) as n_ip, coalesce(n3, 0) as n_card,
    coalesce(n4, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
    coalesce(scores, '') as scores
from given left join told using (r)
"""
