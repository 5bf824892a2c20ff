"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge_rows, frame, rows, words

from tarmac.llm import ranked
from tarmac.llm.ranked import Best, Lists, Vocabulary, postings, search, search_ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plainly(docs, items, k=50):
    """(item_id, rank, doc_id, score) by scoring all documents for all items."""
    bags = [(d, Counter(terms_of(t))) for d, t in docs]
    n_all = sum(1 for _, bag in bags if bag)
    l_all = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms_of(text))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, bag in bags:
            n = sum(bag.values())
            score = 0
            for t in terms & bag.keys():
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + 50 * n * n_all // l_all
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out.append((i, rank, d, -score))
    return sorted(out, key=repr)


def some_docs(rng):
    docs = [(i, " ".join(words(rng, rng.randrange(1, 60), 80))) for i in range(300)]
    copies = [(1000 + i, docs[7][1]) for i in range(120)]
    hot = [(2000 + i, "hot " * (1 + i % 3) + " ".join(words(rng, 5, 80))) for i in range(150)]
    rng.shuffle(docs)
    return [*copies, *docs, *hot, *edge_rows()]


ITEMS = [
    (1, "w1 w2 W3 w2"), (2, None), (3, ""), (4, "!?"), (5, "hot"), (6, "nothing-like this"),
    (7, "w5 hot w6"), (7, "W7"), (8, "Ünïcödé end"), (None, "w9"), (9, "w5 hot w6"), (9, "w5 hot w6"),
]


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id int, text string, score string, term string")


@pytest.mark.parametrize("k, pairs", [(50, 300_000), (3, 300_000), (50, 4)])
def test_search_equals_scoring_all(spark, k, pairs):
    rng = random.Random(k)
    docs = some_docs(rng)
    items = [*ITEMS, *((100 + i, " ".join(words(rng, 12, 100))) for i in range(20))]
    # Long items have as many terms as a small block, so each block takes several scans.
    items = items if pairs > 1000 else items[:8]
    found = search_ranked(
        frame(spark, docs).repartition(5), item_frame(spark, items), k=k, block_pairs=pairs
    )
    assert rows(found, "item_id", "rank", "doc_id", "score") == plainly(docs, items, k)


def test_small_shards_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", 50)
    monkeypatch.setattr(ranked.wordhash, "SLICE_BYTES", 300)
    rng = random.Random(2)
    docs = some_docs(rng)
    found = search_ranked(frame(spark, docs).coalesce(2), item_frame(spark, ITEMS))
    assert rows(found, "item_id", "rank", "doc_id", "score") == plainly(docs, ITEMS)


def test_empty_tables(spark, empty):
    items = item_frame(spark, ITEMS)
    docs = frame(spark, [(1, "w1"), (2, None)])
    assert search_ranked(empty, items).count() == 0
    assert search_ranked(docs, items.limit(0)).count() == 0
    assert search_ranked(frame(spark, [(1, None), (2, " .")]), items).count() == 0
    assert rows(search_ranked(docs, items), "item_id", "rank", "doc_id") == [(1, 1, 1)]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_best_positions_over_shards(data):
    """Random impacts with many ties, dealt to shards, against plain sums."""
    documents, terms = data.draw(st.integers(1, 60)), data.draw(st.integers(1, 6))
    impact = np.array(
        data.draw(st.lists(st.integers(0, 4), min_size=documents * terms, max_size=documents * terms))
    ).reshape(documents, terms)
    wanted = np.array(sorted(data.draw(st.sets(st.integers(0, terms), min_size=1))))
    k = data.draw(st.integers(1, 5))
    best, ids = Best(k), np.arange(documents)[::-1].copy()
    cut = data.draw(st.integers(0, documents))
    for own in (slice(0, cut), slice(cut, documents)):
        doc, term = np.nonzero(impact[own])
        if len(doc):
            part = ids[own]
            lists = Lists(doc, term, impact[own][doc, term], len(part))
            search(lists, wanted, best, np.zeros(len(part), bool), part)
    sums = impact[:, wanted[wanted < terms]].sum(axis=1)
    want = sorted((-s, i) for s, i in zip(sums.tolist(), ids.tolist()) if s > 0)[:k]
    assert list(zip((-best.score).tolist(), best.id.tolist())) == want


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    n = 20_000
    document = np.tile(np.arange(n), 3)
    term = np.repeat(np.arange(3), n)
    impact = (rng.pareto(1.5, 3 * n) * 1000).astype(np.int64) + 1
    best = Best(10)
    read = search(
        Lists(document, term, impact, n), np.arange(3), best, np.zeros(n, bool), np.arange(n)
    )
    sums = impact.reshape(3, n).sum(axis=0)
    assert best.score.tolist() == sorted(sums.tolist(), reverse=True)[:10]
    assert read < n


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """All words of one length share a hash here; bytes decide."""
    monkeypatch.setattr(
        ranked.wordhash.Words, "hashes", lambda self: (self.end - self.start).astype(np.uint64) << np.uint64(50)
    )
    vocabulary = Vocabulary(["abc", "abd", "abcdefghijk", "abcdefghijl", "ü"])
    texts = pa.array(["abc abx ABD", "abcdefghijl abcdefghijm ü ö abc"])
    found = [
        (row + int(d), int(t), int(f))
        for row, p in postings(vocabulary, texts)
        for d, t, f in zip(p.document, p.term, p.tf)
    ]
    assert sorted(found) == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 3, 1), (1, 4, 1)]
