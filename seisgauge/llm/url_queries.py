"""Registered query of the URL filter, and its SQL.

The list is made from the pages: the URLs of pages whose title holds three equal marks in a row,
and of pages whose host has a label of two plain words joined by a hyphen, a habit of hosts that
are bought in bulk. A title says nothing of the URL, so the other addresses of such a page are found
by the list alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .urls import Rule, host_and_path, url_verdicts

RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
TITLE = r"<title>([^<]*)"
MARKS_IN_A_ROW = r"#{3}|[*]{3}|[$]{3}|%{3}|!{3}|[?]{3}|(&amp;){3}"
HYPHENATED = r"(^|[.])[a-z]+-[a-z]+[.]"


def listed_urls(pages: DataFrame) -> DataFrame:
    """``url`` of the pages that make up the list. Null titles and URLs are not listed."""
    host, _ = host_and_path(F.col("url").cast("string"))
    loud = F.regexp_extract(F.col("html").cast("string"), TITLE, 1).rlike(MARKS_IN_A_ROW)
    return pages.where(F.coalesce(loud, F.lit(False)) | host.rlike(HYPHENATED)).select("url")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_verdicts(pages, listed_urls(pages), RULES)


OP8_SQL = r"""
with parts as (
    select page_id, url, strpos(url, '://') > 0 as absolute,
        coalesce(regexp_matches(regexp_extract(html, '<title>([^<]*)', 1),
            '#{3}|[*]{3}|[$]{3}|%{3}|!{3}|[?]{3}|(&amp;){3}'), false) as loud,
        case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), split as (
    select page_id, loud, coalesce(absolute, false) as absolute,
        translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path,
        regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[^?#]*[?]([^#]*)', 1),
            '(^|&)utm_[^&]*', '', 'g'), '^&', '') as query
    from parts
), keyed as (
    select page_id, host, path, loud,
        case when absolute then regexp_replace(host, '^www[.]', '')
            || regexp_replace(path, '(/|[.]html?)$', '')
            || case when query <> '' then '?' || query else '' end end as key
    from split
), list as (
    select distinct key from keyed
    where (loud or regexp_matches(host, '(^|[.])[a-z]+-[a-z]+[.]')) and key is not null
), judged as (
    select page_id, host, path, list.key is not null as listed,
        case
            when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1')
                then 'example.org/en/1'
            when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/')
                then 'example.org/es/'
            when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
            when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
            when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/'
        end as rule
    from keyed left join list using (key)
)
select page_id, host, path, rule, listed,
    case
        when rule in ('org/', 'com/fr/') then 'allow'
        when rule is not null then 'block'
        when listed then 'block'
        else 'allow'
    end as verdict
from judged
"""
