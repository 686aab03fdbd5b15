"""Token files and packing, against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seisgauge.llm.memory import forgetting
from seisgauge.llm.output_queries import TOKENIZER
from seisgauge.llm.packing import Bm25, cuts, pack, retrieval_order
from seisgauge.llm.token_files import read_token_files, token_index, with_global_starts, write_token_files
from seisgauge.llm.tokens import Encoder
from seisgauge.sources.staging import staging_path

from . import odd


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder(tokenizer):
    encode = Encoder.of(TOKENIZER)
    assert encode.words is not None
    texts = [text or "" for _, text, *_ in odd.rows()] + [
        "It's I'LL 'tis don't.. ,.a.,b e\u0301te\u0301 \u0301x ß ẞ Σας ΣΑΣ 𝔘𝔫𝔦 a\u00a0b\u2003c \u200d x\u0130y ÷×",
        "".join(map(chr, range(1, 0x250))), "<|startoftext|>a<|endoftext|> b",
        "été%%% Word### a<b x'&& word'.t word-. it's. end\"'ll é,'s a.b [x] y]|~`", "\ud7ff\ue000 １２ Ⅷ ½",
    ]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_worker_forgets():
    encode = Encoder.of(TOKENIZER)
    run = forgetting(lambda batches: ([encode(batch), len(encode.words)] for batch in batches))
    list(run([]))
    assert [held for _, held in run(["one two", "two three"])] == [2, 3]
    assert not encode.words and not encode.words.cores


def test_token_files(spark, tokenizer):
    docs, root = odd.rows(), staging_path(spark, "tokens")
    index = write_token_files(odd.documents(spark, docs), root, TOKENIZER, end_id=1)
    found = with_global_starts(read_token_files(index), index).orderBy("start").collect()
    ordered = sorted(((d[0], d[1] or "") for d in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    assert [r["doc_id"] for r in found] == [d[0] for d in ordered]
    at = 0
    for row, (_, text) in zip(found, ordered):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert row["start"] == at and row["n_tokens"] == len(ids)
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        at += len(ids)


def test_some_documents_only(spark, tokenizer):
    docs = [(i, f"text number {i}", None, None, None) for i in range(50)]
    root = staging_path(spark, "tokens")
    write_token_files(odd.documents(spark, docs), root, TOKENIZER)
    found = read_token_files(token_index(spark, root).where("doc_id in (7, 31)"), digest=True).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in found} == {
        i: crc(tokenizer.encode(f"text number {i}", add_special_tokens=False).ids) for i in (7, 31)
    }


def test_a_damaged_frame_is_found(spark):
    docs = [(i, f"text number {i} " * 50, None, None, None) for i in range(3)]
    root = staging_path(spark, "tokens")
    index = write_token_files(odd.documents(spark, docs, 1), root, TOKENIZER)
    path = index.first()["path"].removeprefix("file://")
    held = bytearray(open(path, "rb").read())
    held[-11] ^= 1  # a checksum of the seek table
    open(path, "wb").write(held)
    with pytest.raises(Exception, match="checksum"):
        read_token_files(index).collect()


def test_packing(spark, tokenizer):
    docs = odd.rows()
    for window in (4096, 64):
        pieces = pack(odd.documents(spark, docs), TOKENIZER, 2, window).collect()
        by_sequence = defaultdict(list)
        for piece in pieces:
            by_sequence[piece["sequence_id"]].append(piece)
        for held in by_sequence.values():
            at = 0
            for piece in sorted(held, key=lambda p: p["offset"]):
                assert piece["offset"] == at and piece["length"] > 0
                at += piece["length"]
            assert at <= window and at & (at - 1) == 0  # no padding at all
        wanted = Counter()
        for doc_id, text, *_ in docs:
            wanted[doc_id] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
        found = Counter()
        for piece in pieces:
            found[piece["doc_id"]] += piece["length"]
        assert found == wanted
        texts = {d[0]: d[1] or "" for d in docs}
        single = {i for i, n in Counter(d[0] for d in docs).items() if n == 1}
        for piece in pieces:
            if piece["doc_id"] in single:
                ids = tokenizer.encode(texts[piece["doc_id"]], add_special_tokens=False).ids + [2]
                assert piece["doc_tokens"] == len(ids)
                assert piece["ids_crc32"] == crc(ids[piece["start"] : piece["start"] + piece["length"]])


def test_empty_tables(spark):
    assert pack(odd.empty(spark), TOKENIZER, 2).count() == 0
    index = write_token_files(odd.empty(spark), staging_path(spark, "tokens"), TOKENIZER, 1)
    assert read_token_files(index).count() == 0


def test_neighbours_fill_the_window():
    topics = [np.arange(100 * t, 100 * t + 40, dtype=np.uint32) for t in range(4)]
    docs = [topics[i % 4] for i in range(16)]
    order = retrieval_order(docs, np.array([40] * 16), 160)
    assert sorted(order) == list(range(16))
    windows = [[order[4 * w + k] % 4 for k in range(4)] for w in range(4)]
    assert all(len(set(window)) == 1 for window in windows)


def test_cuts():
    assert cuts(4096 * 2 + 5, 4096).tolist() == [0, 4096, 8192, 8196, 8197]
    assert cuts(0, 4096).tolist() == [0]


def test_all_terms_of_a_seed_count():
    """Plain BM25 over a long seed: its rarest terms are in no other document."""
    rng = np.random.default_rng(3)
    docs = [np.concatenate([rng.integers(0, 400, 150), np.arange(1000 * i, 1000 * i + 100)]) for i in range(1, 9)]
    docs += [rng.integers(0, 400, 3) for _ in range(150)]
    docs = [ids.astype(np.uint32) for ids in docs]
    index, used = Bm25(docs), np.zeros(len(docs), bool)
    counts = [Counter(ids.tolist()) for ids in docs]
    held = Counter(term for count in counts for term in count)
    mean = sum(ids.size for ids in docs) / len(docs)

    def score(seed: int, doc: int) -> float:
        total = 0.0
        for term in counts[seed].keys() & counts[doc].keys():
            idf = np.log((len(docs) - held[term] + 0.5) / (held[term] + 0.5))
            n = counts[doc][term]
            total += max(idf, 0) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * docs[doc].size / mean))
        return total

    for seed in range(8):
        used[[seed, *rng.integers(8, len(docs), 25)]] = True
        scores = {d: score(seed, d) for d in np.flatnonzero(~used).tolist()}
        found = list(index.neighbours(seed, used))
        assert set(found) == {d for d, s in scores.items() if s > 0}
        assert np.allclose([scores[d] for d in found], sorted((s for s in scores.values() if s > 0), reverse=True))
