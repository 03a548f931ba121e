"""Targets of the mix and verdicts of the quality rules, against plain versions in exact numbers."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import brute
import pytest
from pyspark.sql import functions as F
from test_operators import CLASH, DOCS

from lapledger.llm import mixing, quality


def plain_targets(sizes):
    """source: target, from source: words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        shares = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(2 * sizes[s]) if s in full else left * weight[s] / shares for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets_of_the_mix(spark, seed):
    r = random.Random(seed)
    share = {s: r.random() ** 2 + 0.02 for s in ("a", "B", "é", "z", "zz", "", None)}
    rows = []
    for i in range(400):
        source = r.choices(list(share), list(share.values()))[0]
        rows.append((i, " ".join("w" for _ in range(r.randint(0, 60))), None, source, 0))
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    expected = plain_targets(sizes)
    sources = {i: source for i, _, _, source, _ in rows}
    found = mixing.mixed(spark.createDataFrame(rows, DOCS)).collect()
    assert all(x.source_size == sizes[sources[x.id]] for x in found)
    assert all(x.target == pytest.approx(float(expected[sources[x.id]]), abs=1e-6) for x in found)


def plain_values(text):
    """Thousandths of each rule, and whether the base rules reject the text."""
    words, chars, symbols, repeated, again = brute.counts(text)
    lines = len([x for x in (text or "").split("\n") if brute.WORD.search(x)])
    capitals = len(re.findall("[A-ZÀ-ÖØ-Þ]", text or ""))
    part = lambda x, of: min(1000, 1000 * x // max(of, 1))
    values = {"symbols": part(symbols, words), "dup_lines": part(repeated, lines), "repeats": part(again, words), "capitals": part(capitals, chars)}
    return values, words < 10 or 100 * again > 20 * words


def few_enough(wrong, n, limit, level):
    """Exact: probability of at most so many rejections at the limit is at most the level."""
    return n > 0 and wrong < n * limit and sum(math.comb(n, k) * limit**k * (1 - limit) ** (n - k) for k in range(wrong + 1)) <= level


def plain_cut(good, bad, limit, level):
    best, gain = 1001, 0
    for cut in range(1000, 0, -1):
        wrong, right = sum(v >= cut for v in good), sum(v >= cut for v in bad)
        if not few_enough(wrong, len(good), limit, level):
            break
        if right - 10 * wrong > gain:
            best, gain = cut, right - 10 * wrong
    return best


def test_verdicts_of_the_rules(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(1_500):
        lang, bad = ("en" if i < 1_200 else "de"), r.random() < 0.3
        words = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 9))) for _ in range(r.randint(8, 30))]
        if bad and r.random() < 0.6:
            words = [w + r.choice(["", "##", "$$$"]) for w in words]
        if r.random() < (0.3 if bad else 0.3):
            words = [w.upper() for w in words]
        text = r.choice([" ", " ", "\n"]).join(words)
        rows.append((i, text + (f"\n{text}" if bad and r.random() < 0.2 else ""), lang, "s", 0))
        if r.random() < 0.9:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame([*rows, (2_000, None, None, None, 0)], DOCS).withColumns({c: F.lit("x") for c in CLASH if c not in ("id",)})
    found = {x.id: x for x in quality.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    values = {i: plain_values(t) for i, t, *_ in rows} | {2_000: plain_values(None)}
    lang, truth = {i: x for i, _, x, *_ in rows} | {2_000: ""}, dict(labels)
    cuts = {}
    for stratum in ("en", "de"):
        held = [i for i in truth if lang[i] == stratum and not values[i][1]]
        for rule in quality.RULES:
            of = lambda kind: [values[i][0][rule] for i in held if truth[i] == kind]  # noqa: E731, B023
            cuts[stratum, rule] = plain_cut(of(1), of(0), Fraction(1, 100), Fraction(5, 100) / 12)
    assert {r for (s, r), c in cuts.items() if c <= 1000} >= {"symbols"}
    for i, (own, failed) in values.items():
        assert found[i].base_failed == failed
        assert found[i].kept == (not failed and all(own[rule] < cuts.get((lang[i], rule), 1001) for rule in quality.RULES))
    assert sum(not x.kept and not x.base_failed for x in found.values()) > 50
