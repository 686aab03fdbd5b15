"""Divergence audit, byte-level BPE and fill-in-the-middle against plain versions."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from seisgauge.llm import byte_pairs, divergence, fill_in_middle
from seisgauge.llm.shipping import ship

from . import odd

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def modules(spark):
    ship(spark)


@pytest.fixture(scope="module")
def tokenizer():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- divergence audit


def plain_audit(docs: list[tuple], least: int, listed: int) -> Counter:
    """docs: (text, lang, source)"""
    groups: dict = {}
    within: Counter = Counter()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = regex.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.setdefault((lang, source), Counter()).update(terms)
        within.update((lang, t) for t in set(terms))
    found = Counter()
    for lang in {lang for lang, _ in groups}:
        kept = [t for (of, t), n in within.items() if of == lang and n >= least]
        sources = {s: c for (of, s), c in groups.items() if of == lang}
        everything = sum(sources.values(), Counter())

        def shares(counts):
            whole = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // whole for t in kept}

        q = shares(everything)
        p = {s: shares(c) for s, c in sources.items()}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, listed)):
                ranked = sorted(items, key=lambda item: (-item[1], item[0].encode()))[:most]
                for rank, (item, value) in enumerate(ranked, 1):
                    found[lang, s, part, item, value, rank] += 1
    return found


def audited(rows) -> Counter:
    return Counter(map(tuple, rows.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_of_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert audited(divergence.audit(docs)) == plain_audit(held, 30, 50)


@pytest.mark.parametrize("block, tile", [(32_768, 8), (7, 2), (1, 1)])
def test_audit_in_blocks_and_tiles(spark, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    chance = random.Random(block)
    words = ["Stone", "river", "été", "ÉTÉ", "saw", "x-y", "İ", "naïve_dash", "好", "z\x00q", "a1b2"] + [
        f"w{chr(97 + k)}" for k in range(20)
    ]
    rows = []
    for k in range(120):
        lang = [None, "", "en", "de"][k % 4]
        source = [None, "", "a", "ä", "b", "c", "d"][k % 7]
        text = None if k % 13 == 0 else " ".join(chance.choice(words) for _ in range(chance.randrange(0, 40)))
        rows.append((k, text, lang, source, None))
    rows += [(1, "...", "quiet", s, None) for s in "pqr"]  # a language without kept terms
    rows += [(2, "only one", "single", "s", None)] * 9  # a language of one source, repeated rows
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(3).withColumns(
        {name: F.lit("x") for name in ("term", "n", "docs", "block", "id", "tile", "part", "item", "rank")}
    )
    wanted = plain_audit([(t, lang, s) for _, t, lang, s, _ in rows], 4, 6)
    assert audited(divergence.audit(docs, 4, 6)) == wanted
    assert any(part == "pair" and value == 0 for _, _, part, _, value, _ in wanted)


def test_audit_of_nothing(spark):
    assert divergence.audit(odd.empty(spark)).count() == 0


def test_gallop_finds_the_places():
    chance = np.random.default_rng(1)
    for size, far in ((0, 5), (5, 0), (1, 1), (300, 20), (70, 5000), (1000, 1000)):
        short = np.unique(chance.integers(0, 6000, size))
        long = np.unique(chance.integers(0, 6000, far))
        assert divergence.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_shares_are_exact():
    for whole in (5, 10, 10**6 + 5, 9 * 10**15):
        counts = np.array([n for n in (0, 1, 5, 10**6, 8 * 10**15) if n + 5 <= whole])
        assert divergence._shares(counts, whole).tolist() == [
            1 + 10**9 * (int(n) + 5) // whole for n in counts
        ]
    assert divergence._shares(counts, 0).tolist() == [0] * len(counts)


def test_long_texts_are_counted_in_portions(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "PORTION", 7)
    text = "Aé b-cc  LongestWordOfAll, 好好 aé".encode() * 3
    wanted = Counter(regex.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.decode()))
    lowered = Counter()
    for term, n in wanted.items():
        lowered["".join(c.lower() if c.isascii() else c for c in term).encode()] += n
    assert divergence._terms_of(pa.py_buffer(text)) == lowered


# --- byte-level BPE


def held_tokens(rows) -> Counter:
    return Counter(
        (r["doc_id"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u4")), bytes(r["body"]))
        for r in rows.collect()
    )


def test_encoding_and_decoding_of_odd_rows(spark, tokenizer):
    given = odd.rows() + [
        (900, " " * 700, None, None, None),
        (901, "ab" * 1001 + "c", None, None, None),
        (902, "x\x1cy\x85z  　tail \n\n  end\x1f", None, None, None),
        (903, "<|endoftext|>'S 's12３४", None, None, None),
    ]
    rows = byte_pairs.round_trip(odd.documents(spark, given), RANKS, public_tokenizers.PATTERN)
    wanted = Counter()
    for doc_id, text, *_ in given:
        ids = tokenizer.encode_ordinary(text or "")
        wanted[doc_id, len(ids), tuple(ids), (text or "").encode()] += 1
    assert held_tokens(rows) == wanted


def test_encoding_of_the_smallest_tables(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = byte_pairs.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    wanted = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode_ordinary(text)
        wanted[doc_id, len(ids), tuple(ids), text.encode()] += 1
    assert held_tokens(rows) == wanted


@pytest.mark.parametrize("short", [0, 100, 10**9])
def test_both_ways_to_merge_give_the_same_ids(tokenizer, monkeypatch, short):
    monkeypatch.setattr(byte_pairs, "SHORT", short)
    vocabulary = byte_pairs.Vocabulary.of(RANKS)
    chance = random.Random(4)
    tokens = [t for t in vocabulary.ranks if not t.isspace()][:4000]
    words = {"".join(chance.choice("theandisouREÉ好") for _ in range(chance.randrange(1, 90))) for _ in range(600)}
    for _ in range(600):  # made of tokens, so that merges compete
        body = b"".join(chance.choice(tokens) for _ in range(chance.randrange(2, 7)))
        if body.isascii():
            words.add(body.decode())
    words |= {"a" * 257, "aaab" * 60}
    with byte_pairs._database({"merges": vocabulary.merges}) as database:
        known = byte_pairs._Words(vocabulary, database)
        known.learn(words)
        for word in words:
            ids = tokenizer._core_bpe.encode_single_piece(word.encode())
            assert np.frombuffer(known[word], "<u4").tolist() == ids, word


def test_what_a_task_remembers_is_bounded(tokenizer, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(byte_pairs, "REMEMBERED", 5)
    monkeypatch.setattr(byte_pairs, "SLICE", 40)
    texts = [f"words numbered {k} of a long row, {k * k}" for k in range(60)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    ids = list(byte_pairs.encoded([batch], RANKS, public_tokenizers.PATTERN))
    assert len(ids) > 30
    bodies = [b for out in byte_pairs.decoded(ids, RANKS) for b in out.column("body").to_pylist()]
    assert bodies == [(t or "").encode() for t in texts]


def test_decoding_alone(spark, tokenizer):
    rows = spark.createDataFrame(
        [(1, bytearray(np.array([15496, 995], "<u4").tobytes())), (2, None), (3, bytearray())],
        "doc_id long, ids binary",
    )
    found = {r["doc_id"]: bytes(r["body"]) for r in byte_pairs.decode(rows, RANKS).collect()}
    assert found == {1: tokenizer.decode_bytes([15496, 995]), 2: b"", 3: b""}
    unknown = rows.select("doc_id", F.lit(bytearray(np.array([60_000], "<u4").tobytes())).alias("ids"))
    with pytest.raises(PythonException):
        byte_pairs.decode(unknown, RANKS).collect()


def test_bpe_of_nothing(spark):
    assert byte_pairs.round_trip(odd.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# --- fill-in-the-middle


def plain_middle(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("piece", [1_000_000, 50])
def test_middles_of_odd_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(fill_in_middle, "SLICE", piece)
    extra = ["a<P>b", "<S>", "x<M>", "<P", "<<S<", "😀é́‍" * 40, "\x00", "<P><S><M>", "p>q<"]
    given = odd.rows() + [(1000 + k, text, None, None, None) for k, text in enumerate(extra * 3)]
    rows = fill_in_middle.fill_in_middle(odd.documents(spark, given))
    back = rows.withColumn("text", fill_in_middle.restored(F.col("output"), F.col("form")))
    found = Counter(map(tuple, back.collect()))
    wanted = Counter(plain_middle(doc_id, text) + (text or "",) for doc_id, text, *_ in given)
    assert found == wanted
    assert {form for _, _, form, *_ in wanted} == {"plain", "psm", "spm"}


def test_middles_of_nothing(spark):
    assert fill_in_middle.fill_in_middle(odd.empty(spark)).count() == 0


def test_markers_that_could_be_mistaken_are_refused():
    fill_in_middle.Markers("[pre]", "[suf]", "[mid]")
    for names in (("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("", "b", "c"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fill_in_middle.Markers(*names)
