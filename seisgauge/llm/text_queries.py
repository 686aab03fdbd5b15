"""Registered queries of the divergence audit, byte-level BPE and fill-in-the-middle."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_pairs, divergence
from .fill_in_middle import fill_in_middle, restored
from .inputs import documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = byte_pairs.round_trip(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("body", 256).alias("decoded_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
words as (
  select row, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs),
kept as (select lang, term from words group by all having count(distinct row) >= 30),
used as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by all),
groups as (select distinct lang, source from docs),
sizes as (
  select g.lang, g.source, (select count(*) from kept k where k.lang = g.lang) as v,
    (select coalesce(sum(n), 0) from used u where u.lang = g.lang and u.source = g.source) as own,
    (select coalesce(sum(n), 0) from used u where u.lang = g.lang) as everything
  from groups g),
shares as (
  select s.lang, s.source, k.term, coalesce(u.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(u.n, 0) + 5)) // (s.own + 5 * s.v)::hugeint as p,
    1 + (1000000000::hugeint * (t.n + 5)) // (s.everything + 5 * s.v)::hugeint as q
  from sizes s join kept k on k.lang = s.lang
  join (select lang, term, sum(n) as n from used group by all) t on t.lang = k.lang and t.term = k.term
  left join used u on u.lang = s.lang and u.source = s.source and u.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from groups a join groups b on b.lang = a.lang and b.source <> a.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all)
select lang, source, 'pair' as part, item, value,
  cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank
from pairs
union all
select lang, source, 'term', term, cast(p - q as bigint),
  cast(row_number() over (partition by lang, source order by p - q desc, term) as integer) as rank
from shares where n > 0 and p > q
qualify rank <= 50
"""

OP13_SQL = """
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents),
numbers as (
  select doc_id, text, length(text) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4
  from drawn),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
           or h3 % 100 >= 90 then 'plain'
         when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from numbers),
pieces as (
  select *, left(text, low) as prefix, substring(text, low + 1, high - low) as middle,
    substring(text, high + 1) as suffix
  from cut)
select doc_id, n, form, case when form <> 'plain' then low end as prefix_chars,
  case when form <> 'plain' then high - low end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from pieces
"""
