"""Built-in operators: personal data, quality rules, URL filter."""

from __future__ import annotations

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seisgauge.llm import personal_data, quality_rules
from seisgauge.llm.queries import ORACLE_SQL, QUERIES
from seisgauge.llm.url_queries import listed_urls
from seisgauge.llm.urls import Rule, blocked_filter, possible_hits, url_verdicts

from ..compare import compare, connect
from . import brute, odd

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLE_SQL[name], SF) is None


def luhn(text: str) -> bool:
    digits = [int(c) for c in re.sub(r"[^0-9]", "", text)][::-1]
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
    return 13 <= len(digits) <= 19 and total % 10 == 0


def iban(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}

TEXTS = [
    "mail a.b@c.de, x@y_z@q.r.s! @@a@b.c.d@e.f a@b a@b. ñ@x.y né.e@ex-a.mp.le.",
    "10.0.0.1 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 001.02.3.255 1.2.3..4 0000000000000000001.1.1.1 9999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559x 4111  1111 1111 1111 4 1 1",
    "call +1 (736) 555-2678 or +49.30.1234567 +1 2 +1234567890123456 ++4912345678 +1(((((2",
    "IBAN GB82WEST12345698765432, account DE89370400440532013000. XDE89370400440532013000 GB82WEST12345698765433",
    "é" * 50 + "a@b.cd" + "ü" * 50 + "+1 (736) 555-2678" + "😀" + "4111111111111111",
    "a" * 30000, "1" * 30000, "1.1" * 9000, "@" * 20000, "+1" + "(" * 20000, "a.b" * 8000 + "@x.y",
    "", None, "nothing here",
]


def test_spans_against_plain_patterns(spark):
    docs = [(i, text, None, None, None) for i, text in enumerate(TEXTS)]
    found = {r["doc_id"]: r["spans"] for r in personal_data.find_spans(odd.documents(spark, docs)).collect()}
    for i, text in enumerate(TEXTS):
        for kind, (pattern, valid) in PLAIN.items():
            wanted = [m.span() for m in re.finditer(pattern, text or "") if valid(m[0])]
            assert [(s["start"], s["end"]) for s in found[i] if s["kind"] == kind] == wanted, (i, kind)
    marks = [TEXTS[4][s["start"] : s["end"]] for s in found[4] if s["kind"] == "iban"]
    assert marks == ["GB82WEST12345698765432", "DE89370400440532013000"] and all(map(iban, marks))
    assert found[3][0]["score"] == pytest.approx(0.9)  # after "call"


def test_spans_of_odd_rows(spark):
    docs = odd.rows()
    found = personal_data.find_spans(odd.documents(spark, docs))
    assert Counter(r["doc_id"] for r in found.collect()) == Counter(d[0] for d in docs)
    assert personal_data.find_spans(odd.empty(spark)).count() == 0


def test_redact(spark):
    docs = [(1, "to a@b.cd, +41 11 11 11 11 11 11 11 bye", "en", "s", 9), (2, None, None, None, None), (3, "clean", "en", "s", 5)]
    frame = odd.documents(spark, docs)
    found = personal_data.redact(frame)
    assert found.columns == frame.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[1].startswith("to [EMAIL], ") and "11" not in texts[1] and texts[1].endswith(" bye")
    assert texts[2] is None and texts[3] == "clean"
    assert personal_data.redact(odd.empty(spark)).count() == 0


def test_context_decides_over_added_spans(spark):
    docs = ["my SSN is 123-45-6789.", "part 123-45-6789 of 9", "ssn 000-45-6789, 123-00-6789, 1234-45-67890"]
    frame = odd.documents(spark, [(i, t, None, None, None) for i, t in enumerate(docs)])
    found = {r["doc_id"]: [tuple(s)[:3] for s in r["spans"]] for r in personal_data.find_spans(frame).collect()}
    assert found == {0: [("ssn", 10, 21)], 1: [], 2: []}
    every = {r["doc_id"]: len(r["spans"]) for r in personal_data.find_spans(frame, least_score=0.0).collect()}
    assert every == {0: 1, 1: 1, 2: 0}
    assert {r["doc_id"]: r["text"] for r in personal_data.redact(frame).collect()} == {
        0: "my SSN is [SSN].", 1: docs[1], 2: docs[2]
    }


def test_very_many_spans(spark):
    text = "".join(f"é{'x' * (k % 7)} to a{k}@b.cd, 10.0.0.{k % 300} " for k in range(60_000)) + "end"
    begun = time.monotonic()
    frame = odd.documents(spark, [(1, text, None, None, None)], 1)
    spans = personal_data.find_spans(frame).first()["spans"]
    for kind in ("email", "ip"):
        pattern, valid = PLAIN[kind]
        wanted = [m.span() for m in re.finditer(pattern, text) if valid(m[0])]
        assert [(s["start"], s["end"]) for s in spans if s["kind"] == kind] == wanted
    wanted, at = [], 0
    for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        wanted.append(f"{text[at:start]}[{kind.upper()}]" if start >= at else "")
        at = max(at, end)
    assert personal_data.redact(frame).first()["text"] == "".join(wanted) + text[at:]
    assert time.monotonic() - begun < 60


@pytest.mark.parametrize("length", [0, 1, 511, 512, 513, 1024, 2000])
def test_redact_at_the_edges_of_chunks(spark, length):
    text = "ü" * length + " a@b.cd" + "😀 " * length + "c@d.ef" + " z" * (length // 2)
    frame = odd.documents(spark, [(1, text, None, None, None)], 1)
    assert personal_data.redact(frame).first()["text"] == re.sub(r"[a-z]@[a-z.]+", "[EMAIL]", text)


def test_ledger(spark):
    docs = odd.rows()
    found = Counter(
        (r["doc_id"], r["n_words"], r["n_repeat_words"], r["n_dup_lines"], r["word_chars"], r["n_symbols"])
        for r in quality_rules.ledger(odd.documents(spark, docs)).collect()
    )
    wanted = Counter()
    for doc_id, text, *_ in docs:
        text = text or ""
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        wanted[
            doc_id, len(words), brute.repeated_words(text), len(lines) - len(set(lines)),
            sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        ] += 1
    assert found == wanted
    assert quality_rules.ledger(odd.empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    rows = quality_rules.ledger(odd.documents(spark)).cache()
    bits = [r["failed_bits"] for r in rows.collect()]
    for r in quality_rules.ablations(rows).collect():
        mask, bit = quality_rules.policy_mask(r["policy"]), quality_rules.RULES[r["rule"]].mask
        assert r["rejected"] == sum(b & mask != 0 for b in bits)
        assert r["rejected_by_it_alone"] == sum(b & mask == bit for b in bits)
    kept = quality_rules.apply_policy(rows, 1)
    assert kept.where("kept").count() == sum(b & 3 == 0 for b in bits)
    rows.unpersist()


RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1")]
URLS = [
    ("http://WWW.Example.org/es/1", "block"), ("https://a.example.org/en/12?x#y", "block"),
    ("http://example.org", "allow"), ("http://badexample.org/es/", "allow"), ("x://org/", "allow"),
    ("http://spam.net/a.html?utm_source=f#t", "block"), ("http://www.spam.net/a/", "block"),
    ("http://spam.net/a?x=1", "allow"), ("http://spam.net/b", "allow"), (None, "allow"), ("spam.net/a", "allow"),
    ("://", "allow"), ("", "allow"),
]


def test_the_list(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.net/x?utm_source=f", "<title>Win $$$ now</title>"),
            (2, "https://www.a.net/x/", "<title>Calm</title>"),
            (3, "http://cheap-things.net/y", None),
            (4, "http://xn--bcher-kva.net/", "<p>$$$</p>"),
            (5, None, "<title>!!!</title>"),
            (6, "http://b.net/", "<title>a ## b ** c</title>"),
        ],
        "page_id long, url string, html string",
    )
    assert {r["url"] for r in listed_urls(pages).collect()} == {"http://a.net/x?utm_source=f", "http://cheap-things.net/y", None}
    found = {r["page_id"]: r["verdict"] for r in url_verdicts(pages, listed_urls(pages), []).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URLS)] + [(None, URLS[5][0])], "page_id long, url string")
    for name in odd.CLASHING:
        if name != "url":
            pages = pages.withColumn(name, F.lit("other"))
    listed = spark.createDataFrame([("https://spam.net/a",), (None,), ("nothing",)], "url string")
    found = {r["page_id"]: r for r in url_verdicts(pages, listed, RULES).collect()}
    assert {i: r["verdict"] for i, r in found.items()} == {i: v for i, (_, v) in enumerate(URLS)} | {None: "block"}
    assert found[0]["host"] == "www.example.org" and found[0]["path"] == "/es/1" and found[0]["rule"] == "example.org/es/"
    assert found[2]["path"] == "" and found[2]["rule"] is None and found[9]["host"] == ""
    assert url_verdicts(pages, listed.limit(0), RULES).where("listed").count() == 0
    assert url_verdicts(pages.limit(0), listed, RULES).count() == 0


def test_bloom_filter_misses_nothing(spark):
    keys = spark.range(5000).select(F.concat(F.lit("site/"), "id").alias("key"))
    others = spark.range(20000).select(F.concat(F.lit("else/"), "id").alias("key"))
    blocks = 5000 // 32 + 1
    bloom = blocked_filter(keys, blocks)
    assert possible_hits(keys, bloom, blocks).where("not possible").count() == 0
    assert possible_hits(others, bloom, blocks).where("possible").count() < 100
