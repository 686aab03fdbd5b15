"""Quality classifier, decontamination and the pipeline."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seisgauge.llm.decontamination import SEED, Block, decontaminate, tiles, words_of
from seisgauge.llm.output_queries import TOKENIZER
from seisgauge.llm.quality_classifier import FEATURES, features, fit, fit_pairs, held_out, keep_good, score
from seisgauge.llm.queries import QUERIES

from . import brute, odd

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op10_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = found.where("held_out").join(labels, "doc_id").select("predicted", "quality", "score").toPandas()
    assert len(both) > 100 and (both.predicted == both.quality).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_held_out_is_the_remainder(spark):
    ids = spark.range(200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in ids)


def test_scores_of_odd_rows(spark):
    docs = odd.rows()
    labels = spark.createDataFrame([(d[0], k % 2) for k, d in enumerate(docs)] + [(None, 1), (1, None), (10**9, 0)], "doc_id long, quality int")
    frame = odd.documents(spark, docs)
    ranking = fit(frame, labels)
    found = score(frame, ranking).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d[0] for d in docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    kept = keep_good(frame, ranking)
    assert kept.columns == frame.columns and kept.count() == sum(r["predicted"] for r in found)
    assert score(odd.empty(spark), ranking).count() == 0
    alone = fit(frame, labels.where("quality = 1"))
    assert {r["score"] for r in score(frame, alone).collect()} == {0.5}


def test_fit_of_repeated_rows(spark):
    docs = spark.createDataFrame([(k, f"{'good words ' * k} {'#' * (k % 5)}") for k in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    once = fit(docs, labels, 6)
    hot = docs.where("doc_id < 4").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k")
    again = fit(docs.union(hot), labels.union(labels).union(labels), 6)
    assert np.array_equal(once.weights, again.weights) and once.mean.tolist() == again.mean.tolist()


def test_pairs_rank_and_threshold():
    chance = np.random.default_rng(1)
    good, bad = chance.normal(1, 0.3, (300, len(FEATURES))), chance.normal(-1, 0.3, (100, len(FEATURES)))
    ranking = fit_pairs(good, bad, 0.25)
    assert (ranking.scores(good) >= 0.5).all() and (ranking.scores(bad) < 0.5).all()
    assert len(features("")) == len(features("a b")) == len(FEATURES)


def plain_tiles(here, there, least=SEED):
    """The longest common run of what is left, found by looking at all places."""
    left, right, chosen = list(here), list(there), []
    while True:
        best = (0, 0, 0)
        for i in range(len(left)):
            for j in range(len(right)):
                n = 0
                while i + n < len(left) and j + n < len(right) and left[i + n] == right[j + n] >= 0:
                    n += 1
                best = min(best, (-n, i, j))
        n, i, j = best
        if -n < least:
            return chosen
        chosen.append((i, j, -n))
        left[i : i - n], right[j : j - n] = [-1] * -n, [-2] * -n


@pytest.mark.parametrize("kinds", [1, 2, 3, 8])
def test_tiles_against_all_places(kinds):
    chance = np.random.default_rng(kinds)
    for _ in range(30):
        there = chance.integers(0, kinds, chance.integers(1, 40))
        here = np.concatenate([chance.integers(-1, kinds, 20), there[10:25], chance.integers(0, kinds, 9), there[:14]])
        assert tiles(here, there) == plain_tiles(here, there)
        assert tiles(here, there, 2) == plain_tiles(here, there, 2)


def test_findings_against_all_places():
    chance = random.Random(8)
    items = [(k, odd.prose(chance, 40)) for k in range(12)]
    block = Block(items)
    for _ in range(25):
        parts = [" ".join(words_of(chance.choice(items)[1])[k : k + 13]) for k in (0, 7, 20)]
        text = " ".join([odd.prose(chance, 30), *parts, "lone"])
        wanted = []
        for item_id, given in items:
            item, doc = words_of(given), words_of(text)
            numbers = {w: k for k, w in enumerate(dict.fromkeys(item))}
            n = sum(t[2] for t in plain_tiles([numbers.get(w, -1) for w in doc], [numbers[w] for w in item]))
            if n:
                wanted.append((-n / len(item), item_id))
        best = min(wanted)
        assert block.findings(text, 0.3) == (best[1], -best[0], sum(-c >= 0.3 for c, _ in wanted))


def test_repeated_words_cost_no_product():
    begun = time.monotonic()
    block = Block([(1, "so " * 4000), (2, "so much " * 2000)])
    assert block.findings("so " * 300_000, 0.5) == (1, 1.0, 1)
    assert block.findings("so much " * 150_000, 0.5) == (2, 1.0, 1)
    assert time.monotonic() - begun < 30


def test_short_items_and_other_scripts():
    clause = "每个人都有权享受教育的自由与平等"
    block = Block([(1, "which is true"), (None, "мир труд май свет дом лес"), (3, clause), (4, "--"), (5, "yes")])
    assert block.findings("Which is true? Which is true!", 0.5) == (1, 1.0, 1)
    assert block.findings("which is true of " + "other words " * 40, 0.5)[2] == 0
    assert block.findings("о мир, труд, май, свет, дом, лес", 0.5) == (None, 1.0, 1)
    assert block.findings("前言" + clause + "结束", 0.5) == (3, 1.0, 1)
    assert block.findings("yes", 0.5) == (5, 1.0, 1) and block.findings("", 0.5) is None
    assert Block([(1, "a b c d e f", 3)]).findings("a b c d e f", 0.5) == (1, 1.0, 3)


def test_decontamination(spark):
    chance = random.Random(2)
    items = [" ".join(f"w{chance.randrange(10**6)}" for _ in range(24)) for _ in range(6)]
    moved = items[1].split()
    docs = [
        (0, "lead in " + items[0] + " and out", None, None, None),
        (1, "x " + " ".join(moved[12:] + ["y"] + moved[:12]).upper() + ".", None, None, None),  # reordered
        (2, " ".join(items[2].split()[:10]) + " other words", None, None, None),  # ten of 24 words
        (3, "clean text " * 40, None, None, None),
        (4, None, None, None, None), (5, "", None, None, None), (None, items[3], None, None, None),
        (6, ", ".join(items[4].split()), None, None, None),
        (7, odd.prose(chance, 5000) + items[5] + odd.prose(chance, 5000), None, None, None),
    ]
    given = [(i, t) for i, t in enumerate(items)] + [(90, None), (None, "a b c d e f"), (91, "of the"), (0, items[0])]
    benchmark = spark.createDataFrame(given, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = {r["doc_id"]: r for r in decontaminate(odd.documents(spark, docs), benchmark).collect()}
    assert {i for i, r in found.items() if not r["kept"]} == {0, 1, 6, 7, None}
    assert found[1]["item_id"] == 1 and found[1]["coverage"] == 1.0
    assert found[2]["coverage"] == pytest.approx(10 / 24) and found[0]["n_items"] == 2
    assert decontaminate(odd.documents(spark, docs), benchmark.limit(0)).where("not kept").count() == 0
    assert decontaminate(odd.empty(spark), benchmark).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    from seisgauge.llm import decontamination

    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {tuple(r) for r in decontaminate(docs, benchmark).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 9000)
    assert {tuple(r) for r in decontaminate(docs, benchmark).collect()} == whole
    assert sum(not r[-1] for r in whole) > 10


def test_best_item_against_all_items():
    chance = random.Random(4)
    items = [(k, odd.prose(chance, 30)) for k in range(20)]
    block = Block(items)
    for item_id, text in items:
        assert block.findings("so " + text, 0.5)[:2] == (item_id, 1.0)
    assert words_of("A-b, ÉÉ") == ["a", "b", "éé"]


def test_pipeline(spark):
    """Each stage of sf0.001 against a plain version, on what the stage before kept."""
    sf_dir = "/root/testdata/sf0.001"
    rows = corpus_pipeline.documents(spark, sf_dir).cache()
    held = {r["doc_id"]: r for r in rows.collect()}
    good = {r["doc_id"] for r in QUERIES["op10_quality_classifier"](spark, sf_dir).where("predicted = 1").collect()}
    found = corpus_pipeline.quality(spark, rows, sf_dir)
    assert found.columns == rows.columns and {r["doc_id"] for r in found.collect()} == good

    texts = [(i, held[i]["text"]) for i in sorted(good)]
    found = corpus_pipeline.deduplicate(spark, found, sf_dir)
    kept = {key[0] for key in brute.near_components(texts, 5) if key[-1]}
    assert {r["doc_id"] for r in found.collect()} == kept and found.columns == rows.columns

    found = corpus_pipeline.decontaminate(spark, found, sf_dir)
    items = [" ".join(words_of(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i in kept if not any(item in " ".join(words_of(held[i]["text"])) for item in items)}
    assert {r["doc_id"] for r in found.collect()} == clean and found.columns == rows.columns

    found = corpus_pipeline.hide_personal_data(spark, found, sf_dir)
    hidden = {r["doc_id"]: r for r in found.collect()}
    assert set(hidden) == clean and found.columns == rows.columns
    for i, r in hidden.items():
        text = held[i]["text"]
        assert not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+[.][A-Za-z]", r["text"]) and r["n_chars"] == len(r["text"])
        if not re.search(r"[0-9@]", text):
            assert r["text"] == text

    pieces = corpus_pipeline.packed(spark, found, sf_dir).collect()
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(p["length"] for p in pieces) == sum(p["length"] for p in whole)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    sizes = {i: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in hidden.items()}
    packed = Counter()
    for piece in whole:
        packed[piece["doc_id"]] += piece["length"]
    assert packed == Counter(sizes)
    rows.unpersist()


def test_pipeline_of_odd_rows(spark):
    rows = odd.documents(spark)
    for _, function in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stage(function(spark, rows, SF), "odd")
    assert rows.count() > 0
    rows = odd.empty(spark)
    for _, function in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stage(function(spark, rows, SF), "empty")
    assert rows.count() == 0


def test_pipeline_judges_each_row(spark):
    """Null and repeated ids: near copies and benchmark passages go, whatever their ids."""
    chance = random.Random(12)
    base, other, clean = odd.prose(chance, 120), odd.prose(chance, 120), odd.prose(chance, 120)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    given = [
        (9, base), (4, base), (4, base), (None, odd.changed(chance, base, 1)),
        (None, other), (None, other), (4, clean), (7, item), (None, item), (8, None), (None, None),
    ]
    frame = odd.documents(spark, [(i, text, None, None, None) for i, text in given])
    rows = corpus_pipeline.deduplicate(spark, frame, SF)
    assert rows.columns == frame.columns
    found = Counter((r["doc_id"], r["text"]) for r in rows.collect())
    assert found == Counter([(4, base), (None, other), (4, clean), (7, item), (8, None), (None, None)])
    given = [(4, clean), (4, item), (None, item), (None, other), (5, None), (None, None)]
    frame = odd.documents(spark, [(i, text, None, None, None) for i, text in given])
    rows = corpus_pipeline.decontaminate(spark, frame, SF)
    assert rows.columns == frame.columns
    assert Counter((r["doc_id"], r["text"]) for r in rows.collect()) == Counter(
        [(4, clean), (None, other), (5, None), (None, None)]
    )


def test_fit_of_every_labelled_row(spark, monkeypatch):
    """A fit in blocks of 40 follows all 600 rows, like a fit in one block does."""
    from seisgauge.llm import quality_classifier

    chance = random.Random(5)
    given = [(k, odd.prose(chance, 20 + k % 50) + " #|" * (k % 3 == 0) * chance.randrange(3)) for k in range(600)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(600)], "doc_id long, quality int")
    whole = fit(docs, labels)
    x = {label: np.array([features(t) for k, t in given if (k % 3 > 0) == label]) for label in (0, 1)}
    alone = fit_pairs(x[1], x[0], 1 / 3)
    assert np.allclose(whole.weights, alone.weights) and whole.threshold == pytest.approx(alone.threshold)
    monkeypatch.setattr(quality_classifier, "LEAST", 10)
    monkeypatch.setattr(quality_classifier, "BINS", 4)
    dealt = fit(docs, labels, 40)
    # Mean, scale and the share below the threshold come from all rows, not from 40 of each label.
    assert np.allclose(dealt.mean, alone.mean) and np.allclose(dealt.scale, alone.scale)
    scores = np.concatenate([dealt.scores(x[1]), dealt.scores(x[0])])
    assert (scores < 0.5).mean() == pytest.approx(1 / 3, abs=0.01)
    # A rare label comes to every block.
    rare = fit(docs, labels.where("doc_id < 12 or quality = 1"), 40)
    assert np.isfinite(rare.threshold) and np.abs(rare.weights).max() > 0
    assert np.allclose(rare.mean, (x[1].mean(0) + x[0][:4].mean(0)) / 2)
