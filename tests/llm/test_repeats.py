"""Repeated strings, repeated passages and near duplicates, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seisgauge.llm.automaton_dedup import least_documents, remove_passages
from seisgauge.llm.components import components
from seisgauge.llm.near_duplicates import joining_links, minhashes, near_duplicates, shingles
from seisgauge.llm.segments import sliding_least, spans
from seisgauge.llm.suffix_dedup import Transform, remove_repeats, repeated_windows

from . import brute, odd


def counted(frame) -> Counter:
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    docs = odd.rows(seed)
    assert counted(remove_repeats(odd.documents(spark, docs))) == brute.repeats(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    docs = odd.rows(seed)
    found = remove_passages(odd.documents(spark, docs))
    assert counted(found.select("doc_id", "n_words", "n_removed", "n_spans", "kept_sha256")) == brute.passages(docs)


@pytest.mark.parametrize("operator", ["op1", "op5"])
def test_a_phrase_with_many_neighbours(spark, monkeypatch, operator):
    """A phrase in a third of all documents gives one fingerprint many bodies: no task merges more
    than the bound, or builds an automaton of more."""
    from seisgauge.llm import automaton_dedup, suffix_dedup

    name, bound, module = ("MERGED", 3000, suffix_dedup) if operator == "op1" else ("SHARD_WORDS", 200, automaton_dedup)
    monkeypatch.setattr(module, name, bound)
    if operator == "op1":

        def held(bodies, depth, merge=suffix_dedup.repeated_windows):
            assert sum(map(len, bodies)) <= 2 * 3000, "too much for one merge"
            return merge(bodies, depth)

        monkeypatch.setattr(module, "repeated_windows", held)
    else:

        def built(bodies, window, build=automaton_dedup.least_documents):
            assert sum(body.count(b" ") + 1 for body, _ in bodies) <= 2 * 200, "too much for one automaton"
            return build(bodies, window)

        monkeypatch.setattr(module, "least_documents", built)
    chance = random.Random(11)
    phrase = odd.prose(chance, 200)[:150] if operator == "op1" else " ".join(odd.prose(chance, 40).split()[:10])
    ends = [odd.prose(chance, 40) for _ in range(6)]
    texts = [f"{odd.prose(chance, 60)} {phrase} {odd.prose(chance, 60) if k % 3 else chance.choice(ends)}" for k in range(80)]
    texts += [odd.prose(chance, 80) for _ in range(160)] + texts[:2]
    docs = [(i, text, None, None, None) for i, text in enumerate(texts)] + odd.rows(5)
    frame = odd.documents(spark, docs)
    if operator == "op1":
        assert counted(remove_repeats(frame)) == brute.repeats(docs)
    else:
        assert counted(remove_passages(frame)) == brute.passages(docs)


@pytest.mark.parametrize("length", [4, 5])
def test_near_duplicates(spark, length):
    docs = odd.rows(3)
    found = near_duplicates(odd.documents(spark, docs), length)
    assert counted(found) == brute.near_components(docs, length)


def test_removed_texts_come_back(spark):
    docs = odd.rows(4)
    rest = {r["kept_sha256"]: bytes(r["kept"]) for r in remove_repeats(odd.documents(spark, docs), with_text=True).collect()}
    import hashlib

    assert all(hashlib.sha256(text).hexdigest() == digest for digest, text in rest.items())
    words = remove_passages(odd.documents(spark, docs), with_text=True).collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in words)
    assert len(words) == len(docs)


def test_empty_tables(spark):
    for operator in (remove_repeats, remove_passages, near_duplicates):
        assert operator(odd.empty(spark)).count() == 0


def test_hot_group_of_near_copies(spark):
    """A third of all rows are edits of one text, and a passage stands in the others."""
    chance = random.Random(9)
    base, passage = odd.prose(chance, 120), odd.prose(chance, 40)
    texts = [odd.changed(chance, base, chance.randrange(4)) for _ in range(60)]
    texts += [odd.prose(chance, 60) + passage for _ in range(120)]
    docs = [(i, text, None, None, None) for i, text in enumerate(texts)]
    assert counted(near_duplicates(odd.documents(spark, docs), 4)) == brute.near_components(docs, 4)


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=3, max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=12), st.integers(1, 9))
def test_merged_transforms(bodies, depth):
    seen = Counter(b[i : i + depth] for b in bodies for i in range(len(b) - depth + 1))
    found = repeated_windows(bodies, depth)
    assert [f.tolist() for f in found] == [
        [seen[b[i : i + depth]] > 1 for i in range(len(b) - depth + 1)] for b in bodies
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=5))
def test_transform_sorts_suffixes(texts):
    shard, joined = Transform(texts), b"\xff".join(texts) + b"\xff"
    suffix = lambda at: bytes(x + 1 for x in joined[at : joined.index(b"\xff", at)])
    ordered = [suffix(at) for at in shard.places.tolist()]
    assert ordered == sorted(ordered)


@settings(max_examples=60, deadline=None)
@given(st.lists(words, min_size=1, max_size=8), st.integers(1, 3))
def test_automaton(passages, window):
    bodies = [(b" ".join(p), doc) for doc, p in enumerate(reversed(passages))]
    least: dict[tuple, int] = {}
    for body, doc in bodies:
        held = body.split(b" ")
        for i in range(len(held) - window + 1):
            key = tuple(held[i : i + window])
            least[key] = min(doc, least.get(key, doc))
    for (body, _), found in zip(bodies, least_documents(bodies, window)):
        held = body.split(b" ")
        assert found.tolist() == [least[tuple(held[i : i + window])] for i in range(len(held) - window + 1)]


@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 12))
def test_sliding_least(values, width):
    held = np.array(values, np.uint64)
    assert sliding_least(held, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_spans_join_what_touches():
    assert spans([5, 0, 2], [6, 2, 3]) == [(0, 3), (5, 6)]


def test_minhashes_estimate_similarity():
    text = odd.prose(random.Random(5), 400)
    near = odd.changed(random.Random(6), text, 8)
    a, b = shingles(text, 5), shingles(near, 5)
    true = np.intersect1d(a, b).size / np.union1d(a, b).size
    assert abs((minhashes(a) == minhashes(b)).mean() - true) < 0.2


def test_components(spark):
    chance = random.Random(3)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 4000 + i) for i in range(100)] + [(7, 7)]
    found = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    least = {x: x for link in links for x in link}
    for _ in range(len(links)):
        before = dict(least)
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
        if before == least:
            break
    assert found == {x: m for x, m in least.items() if x != m}


def test_joining_links():
    chance = random.Random(8)
    base = odd.prose(chance, 200)
    texts = [odd.changed(chance, base, k % 9) for k in range(60)] + [odd.prose(chance, 80) for _ in range(5)]
    sets, nodes = [shingles(text, 4) for text in texts], list(range(len(texts)))
    links = joining_links(nodes, nodes, sets, 80)
    parent = list(nodes)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        parent[root(u)] = root(v)
    for i in nodes:
        for j in nodes[:i]:
            same = np.intersect1d(sets[i], sets[j]).size
            linked = 100 * same >= 80 * (sets[i].size + sets[j].size - same)
            assert not linked or root(i) == root(j)
            assert linked or (i, j) not in links and (j, i) not in links


@pytest.mark.parametrize("gathered", [3, 40])
def test_buckets_of_any_size(spark, monkeypatch, gathered):
    """Small bounds, so that buckets are gathered and split as large ones are."""
    from seisgauge.llm import near_duplicates as module

    monkeypatch.setattr(module, "FEW", 1)
    monkeypatch.setattr(module, "GATHERED", gathered)
    chance = random.Random(10)
    base = odd.prose(chance, 100)
    texts = [odd.changed(chance, base, chance.randrange(14)) for _ in range(70)]
    docs = [(i, text, None, None, None) for i, text in enumerate(texts)]
    assert counted(module.near_duplicates(odd.documents(spark, docs), 4)) == brute.near_components(docs, 4)


def test_many_outside_a_large_component_do_not_make_pairs_with_all_of_it(spark, monkeypatch):
    """Texts that resemble a group of near copies, but not enough to be linked with it."""
    from seisgauge.llm import near_duplicates as module

    pairs = []

    def staged(rows, name, stage=module.stage):
        held = stage(rows, name)
        if name == "pairs":
            pairs.append(held.count())
        return held

    monkeypatch.setattr(module, "stage", staged)
    chance = random.Random(12)
    base = odd.prose(chance, 200)
    texts = [odd.changed(chance, base, 1) for _ in range(60)] + [odd.changed(chance, base, 11) for _ in range(100)]
    docs = [(i, text, None, None, None) for i, text in enumerate(texts)]
    assert counted(module.near_duplicates(odd.documents(spark, docs), 4)) == brute.near_components(docs, 4)
    # The first round compares with the least of each bucket.
    assert sum(pairs[1:]) <= 4 * len(docs), pairs


@pytest.mark.parametrize("order", [0, 1])
def test_near_copies_of_any_text_of_an_id_are_linked(spark, order):
    chance = random.Random(8)
    a, b = odd.prose(chance, 160), odd.prose(chance, 170)
    near_a, near_b = odd.changed(chance, a, 2), odd.changed(chance, b, 2)
    for rows in (
        [(1, a), (1, b), (2, near_a), (3, near_b)],
        [(1, a), (5, a), (5, b), (6, near_b)],
        [(4, b), (5, a), (5, b), (5, b), (6, near_a), (7, near_b), (9, a)],
    ):
        docs = [(doc_id, text, "en", None, None) for doc_id, text in (rows[::-1] if order else rows)]
        found = near_duplicates(odd.documents(spark, docs, 1 + order), 4)
        assert counted(found) == brute.near_components(docs, 4)


def staged_rows(monkeypatch, module, name):
    """How many rows a step stages under ``name``."""
    counts = []

    def staged(rows, own, stage=module.stage):
        held = stage(rows, own)
        if own == name:
            counts.append(held.count())
        return held

    monkeypatch.setattr(module, "stage", staged)
    return counts


@pytest.mark.parametrize("operator", ["op1", "op5"])
def test_what_only_copies_share_makes_no_segments(spark, monkeypatch, operator):
    from seisgauge.llm import automaton_dedup, suffix_dedup

    chance = random.Random(21)
    texts = [odd.prose(chance, 200) for _ in range(6)]
    docs = [(i, texts[i % 6], None, None, None) for i in range(30)] + [(None, texts[0], None, None, None)]
    # Some stands in another document, too.
    docs.append((40, texts[1][300:900], None, None, None))
    module = suffix_dedup if operator == "op1" else automaton_dedup
    counts = staged_rows(monkeypatch, module, "candidates")
    frame = odd.documents(spark, docs)
    if operator == "op1":
        assert counted(remove_repeats(frame)) == brute.repeats(docs)
    else:
        assert counted(remove_passages(frame)) == brute.passages(docs)
    assert counts == [2]


@pytest.mark.parametrize("operator", ["op1", "op5"])
def test_bodies_that_are_alike_are_told_together(spark, monkeypatch, operator):
    from seisgauge.llm import automaton_dedup, suffix_dedup

    module = suffix_dedup if operator == "op1" else automaton_dedup
    units = suffix_dedup.byte_units() if operator == "op1" else automaton_dedup.word_units()
    run = suffix_dedup._repeats if operator == "op1" else automaton_dedup._least_by_window
    caught = []
    monkeypatch.setattr(module, "grouped", lambda found, sights: _Run(caught))
    monkeypatch.setattr(module, "by_size", lambda found, units, bound: (found, None))
    run(None, units)
    bodies = [module.Body(k, k, 3, b"", 2, 5) for k in range(50)]
    monkeypatch.setattr(module, "fingerprint_groups", lambda batches: ([body] for body in bodies))
    found = list(caught[0]([]))
    assert sum(b.num_rows for b in found) == 50 and len(found) == 1


class _Run:
    def __init__(self, caught):
        self.caught = caught

    def mapInArrow(self, run, schema):
        self.caught.append(run)
        return self


def test_more_ranks_than_a_half_holds():
    """Runs of eight symbols have more ranks than 16 bits tell apart."""
    chance = random.Random(23)
    texts = [bytes(chance.choices(range(32, 127), k=30_000)) for _ in range(4)]
    bodies = texts + [texts[0][5_000:5_300] + texts[1][100:350]]
    found = repeated_windows(bodies, 200)
    assert [np.flatnonzero(f).tolist() for f in found] == [
        list(range(5_000, 5_101)), list(range(100, 151)), [], [], [*range(101), *range(300, 351)],
    ]
