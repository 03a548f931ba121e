"""Ranked search: against scoring every pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import LOWER, some_texts
from pyspark.sql import functions as F
from test_operators import CLASH, DOCS, ODD

from lapledger.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, best=10):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    held = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    result = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 25 + 75 * c.total() * n // total if total else 25
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        result += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:best], 1)]
    return sorted(result, key=str)


def frames(spark, docs, items):
    rows = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in docs], DOCS).withColumns({c: F.lit("x") for c in CLASH if c != "id"})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("y") for c in ("id", "n", "number", "item", "block")})
    return rows.repartition(4), asked


def some(seed):
    texts = some_texts(seed, 250, vocabulary=300)
    docs = list(enumerate(ODD + texts)) + [(None, texts[0]), (None, None), (7, texts[1]), (7, texts[1])]
    docs.append((5_000, " ".join(texts) * 3))
    items = [(i, t) for i, t in enumerate(texts[::9])] + [(50, None), (51, ""), (52, "w1 W1 w2!w3"), (3, "nothing-of-it"), (None, texts[2]), (53, "w1 " * 2_000)]
    return docs, items


@pytest.mark.parametrize("block, cells", [(512, 1 << 23), (20, 1_500)])
def test_ranked_search(spark, monkeypatch, block, cells):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    docs, items = some(4)
    found = [tuple(r) for r in ranked_search.ranked(*frames(spark, docs, items)).collect()]
    assert sorted(found, key=str) == plain(docs, items)
    assert any(rank == 10 for _, rank, *_ in found)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same text") for i in range(40, 0, -1)] + [(99, "other words here")]
    found = [tuple(r) for r in ranked_search.ranked(*frames(spark, docs, [(1, "same"), (2, "other")])).orderBy("item", "rank").collect()]
    assert sorted(found, key=str) == plain(docs, [(1, "same"), (2, "other")])
    assert [x[2] for x in found if x[0] == 1] == list(range(1, 11))


def test_empty_tables(spark):
    docs, items = some(5)
    rows, asked = frames(spark, docs, items)
    assert ranked_search.ranked(rows.limit(0), asked).count() == 0
    assert ranked_search.ranked(rows, asked.limit(0)).count() == 0


def test_runs_of_items_have_matrices_of_bounded_size(monkeypatch):
    monkeypatch.setattr(ranked_search, "CELLS", 40)
    items = [(i, np.unique(np.arange(i, i + 1 + i % 9)), None) for i in range(50)] + [(50, np.arange(100), None)]
    runs = list(ranked_search.matrices(items))
    assert [x[0] for run, _ in runs for x in run] == list(range(51))
    assert all(len(run) * len(terms) <= 40 or len(run) == 1 for run, terms in runs)
    assert all(set(terms) == {t for x in run for t in x[1]} for run, terms in runs)


def some_matrices(seed, large=1):
    r = np.random.Generator(np.random.PCG64(seed))
    # groups of documents and of items that share few terms with the others
    weights, values = np.zeros((40, 60), np.int64), np.zeros((400, 60), np.int32)
    for rows, most in ((weights, 9_000 * large), (values, 900_000)):
        for row in rows:
            group = r.integers(0, 4)
            at = 15 * group + r.integers(0, 15, 6)
            row[at] = r.integers(1, most, 6)
    return weights, values


@pytest.mark.parametrize("large", [1, 10**7])
def test_pruning_is_exact_and_prunes(large):
    weights, values = some_matrices(1, large)
    best = ranked_search.Best(len(weights), 10)
    tree = ranked_search.Tree(weights, ranked_search.ITEM_LEAF)
    scored, ids = 0, np.arange(len(values))[::-1]
    for at in range(0, len(values), 100):
        scored += ranked_search.search(tree, weights, values[at : at + 100], ids[at : at + 100], np.zeros(100, bool), best)
    for item, row in enumerate(weights.astype(object) @ values.astype(object).T):
        assert best.found[item] == sorted((-s, False, int(i)) for s, i in zip(row, ids) if s > 0)[:10]
    assert scored < weights.shape[0] * len(values) / 2


def test_bounds_hold_for_all_members():
    weights, values = some_matrices(2)
    items, docs = ranked_search.Tree(weights, 4), ranked_search.Tree(values, 16)
    scores = weights @ values.T.astype(np.int64)
    bounds = items.most @ docs.most.T
    for i, ours in enumerate(items.rows):
        for d, theirs in enumerate(docs.rows):
            assert bounds[i, d] >= scores[np.ix_(ours, theirs)].max()
