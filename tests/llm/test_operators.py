from __future__ import annotations

import hashlib
import json
import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapledger.llm import chat, html, line_dedup, mixing, ngram_join, packing, quality, substrings, toxicity, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use names of inside.
CLASH = ["id", "h", "n", "key", "token", "place", "component", "block", "size", "mark", "removed", "line", "stratum"]


def documents(spark, texts, source="a"):
    """A table of documents with clashing columns; ids from 0."""
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({c: F.lit("x") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


ODD = [None, "", " \n\t ", "one", "one", "ONE", "a b c", "é\x85ü 😀", "x " * 3000]


def test_ngram_join(spark, empty):
    texts = ODD + brute.some_texts(1, 150)
    docs = documents(spark, texts)
    for k, percent in ((4, 85), (5, 80), (1, 50)):
        found = {tuple(r) for r in ngram_join.similar(docs, width=k, percent=percent).collect()}
        assert found == brute.similar(list(enumerate(texts)), k, percent)
    assert ngram_join.similar(empty).count() == 0


def test_sets_are_kept_tight():
    r = np.random.Generator(np.random.PCG64(3))
    for n in (0, 1, 2, 5_000):
        tokens = np.concatenate([np.sort(part) for part in np.array_split(r.integers(0, 2**64, n, dtype=np.uint64), max(1, n // 300))])
        blob = ngram_join.tight(tokens)
        assert (ngram_join.loose(memoryview(blob), n) == tokens).all()
    assert len(blob) < 7.4 * n


def test_ngram_join_of_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (7, "a b c d e f"), (7, "k l m n o p"), (3, "k l m n o p"), (None, None), (9, None)]
    found = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 0), (1, 1), (3, 1), (7, 1), (7, 1), (9, 9)]


def test_a_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"new{i}"] + base[i + 1 :]) for i in range(0, 200, 2)]
    found = ngram_join.similar(documents(spark, texts)).collect()
    assert {r.component_id for r in found} == {0}


@pytest.mark.parametrize("width, percent, n", [(4, 85, 93), (5, 80, 60)])
def test_a_text_and_the_same_with_words_added_are_linked(spark, width, percent, n):
    texts = []
    for share in (5, 8, 11, 15):
        base, more = [f"s{share}w{i}" for i in range(n)], [f"s{share}new{i}" for i in range(n * share // 100)]
        texts += [" ".join(base), " ".join(base + more), " ".join(base[: n // 2] + ["odd"] + base[n // 2 :] + more[:2])]
    found = {tuple(r) for r in ngram_join.similar(documents(spark, texts), width=width, percent=percent).collect()}
    assert found == brute.similar(list(enumerate(texts)), width, percent)
    assert sum(i != c for i, _, c in found) == 8


def test_substrings(spark, empty):
    texts = ODD + brute.some_texts(2, 120, vocabulary=150)
    found = {r.id: (r.n_words, r.text, r.n_removed) for r in substrings.without_repeats(documents(spark, texts)).collect()}
    expected = brute.without_repeats(list(enumerate(texts)))
    assert {i: x[:2] for i, x in found.items()} == expected
    assert all(n - gone == len(text.split(" ")) - (not text) for n, text, gone in found.values())
    assert substrings.without_repeats(empty).count() == 0
    other = spark.createDataFrame([(None, texts[-1] * 30), (None, texts[-1] * 30), (1, None)], "doc_id long, text string")
    assert [r.n_removed for r in substrings.without_repeats(other).collect()] == [0, 0, 0]
    with pytest.raises(ValueError):
        substrings.repeats(empty, length=3)


def test_spans_are_maximal(spark):
    words = [f"w{i}" for i in range(100)]
    docs = documents(spark, [" ".join(words), " ".join(["x", *words[10:60], "y", *words[40:90]])])
    [row] = substrings.repeats(docs).collect()
    assert (row.id, [tuple(s) for s in row.spans]) == (1, [(1, 51), (52, 102)])


def test_vectors(spark):
    r = random.Random(3)
    rows = [(0, None, 1), (1, [], 1), (2, [0.0] * 64, 1), (3, [1.0, None] * 32, 1), (4, [math.nan] * 64, 1), (5, [math.inf] * 64, 1), (6, [1.0] * 3, 1), (7, [2.0] * 3, 1), (8, [1.0] * 64, None), (9, [1.0] * 64, None)]
    base = [[r.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    for i in range(10, 160):
        v = r.choice(base)
        rows.append((i, [float(np.float32(x + r.gauss(0, 0.12))) for x in v], r.choice([1, 1, 2])))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in CLASH})
    found = {x.id: (x.n_links, x.component_id) for x in vectors.near_duplicates(frame.repartition(3)).collect()}
    expected = brute.linked_vectors(rows)
    assert found == expected
    assert sum(n for n, _ in expected.values()) > 100
    assert vectors.near_duplicates(frame.limit(0)).count() == 0
    null = spark.createDataFrame([(None, [1.0] * 8, 1), (2, [1.0] * 8, 1), (2, [1.0] * 8, 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((x.id or 0, x.n_links, x.kept) for x in vectors.near_duplicates(null).collect()) == [(0, None, None), (2, 0, True), (2, 0, True)]


def test_copies_of_a_vector_are_one_with_a_weight(spark):
    r = random.Random(6)
    base = [[float(np.float32(r.gauss(0, 1))) for _ in range(32)] for _ in range(4)]
    near = [[float(np.float32(x + r.gauss(0, 0.02))) for x in v] for v in base]
    rows = [(i, r.choice(base + near), r.choice([1, 2])) for i in range(300)] + [(300 + i, [0.0] * 32, 1) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    found = {x.id: (x.n_links, x.component_id) for x in vectors.near_duplicates(frame).collect()}
    assert found == brute.linked_vectors(rows)
    assert found[302] == (0, 302)
    # an id with several vectors: links of all of them, none with itself
    twins = [(1, base[0], 1), (1, base[0], 1), (1, near[0], 1), (2, base[0], 1), (3, near[0], 1), (4, base[1], 1)]
    found = {x.id: (x.n_links, x.component_id) for x in vectors.near_duplicates(spark.createDataFrame(twins, frame.schema)).collect()}
    assert found == {1: (6, 1), 2: (4, 1), 3: (4, 1), 4: (0, 4)}


def test_crowded_cells_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 7)
    r = random.Random(4)
    base = [r.gauss(0, 1) for _ in range(16)]
    rows = [(i, [float(np.float32(x + r.gauss(0, 0.08))) for x in base], 1) for i in range(80)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {x.id: (x.n_links, x.component_id) for x in found} == brute.linked_vectors(rows)


def _lines(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abcde fgh") for _ in range(r.randint(18, 40))) for _ in range(12)]

    def near(line):
        chars = list(line)
        for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
            at, kind = r.randrange(len(chars)), r.random()
            chars[at : at + (kind > 0.3)] = [] if kind > 0.7 else [r.choice("xyz é😀")]
        return "".join(chars)

    return ["\n".join(r.choice([near(r.choice(base)), "short", "", "".join(r.choice("abcdefgh ") for _ in range(30))]) for _ in range(r.randint(0, 6))) for _ in range(70)]


def test_verification_splits_each_text_once(spark):
    left = spark.createDataFrame([(1, "a" * 30)], "k int, x string")
    right = spark.createDataFrame([(1, "a" * 29 + "b")], "k int, y string")
    near = line_dedup.close(left.join(right, "k"), 2)
    assert near._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
    assert near.count() == 1


def test_a_group_of_near_equal_lines_meets_one_of_them(spark):
    lines = [f"a line that is nearly like all the others {i:02d}" for i in range(60)]
    texts = ["\n".join(lines[i : i + 5]) for i in range(0, 60, 5)] + ["nothing of the kind at all, but as long"]
    found = {r.id: r.removed for r in line_dedup.removals(documents(spark, texts)).collect()}
    assert {i: r for i, r in found.items() if r} == brute.removed_lines(list(enumerate(texts)))


def test_line_dedup(spark, empty):
    texts = [None, "", "\n\n", *_lines(5)]
    docs = documents(spark, texts)
    expected = brute.removed_lines(list(enumerate(texts)))
    found = {r.id: r for r in line_dedup.removals(docs).collect()}
    assert {i: r.removed for i, r in found.items() if r.removed} == expected and expected
    assert all(found[i].n_lines == (0 if t is None else len(t.split("\n"))) for i, t in enumerate(texts))
    cleaned = line_dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns
    kept = {i: t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in expected.get(i, ())) for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in cleaned.collect()} == kept
    assert line_dedup.removals(empty).count() == 0
    line = "a line that is long enough"
    rows = line_dedup.removals(spark.createDataFrame([(None, line), (None, line), (4, line), (4, line), (5, line)], "doc_id long, text string"))
    assert sorted((r.id or 0, len(r.removed)) for r in rows.collect()) == [(0, 0), (0, 0), (4, 0), (4, 0), (5, 1)]


def test_banded_distance(spark):
    r, pairs = random.Random(6), []
    for _ in range(800):
        a = [r.choice("abé😀") for _ in range(r.randint(4, 14))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            at, kind = r.randrange(len(b)), r.random()
            b[at : at + (kind > 0.3)] = [r.choice("ab")] if kind < 0.7 or len(b) < 2 else []
        pairs.append(("".join(a), "".join(b)))
    frame = spark.createDataFrame(pairs, "x string, y string")
    for most in (1, 2, 3):
        found = {(x.x, x.y) for x in line_dedup.close(frame, most).collect()}
        assert found == {(a, b) for a, b in pairs if brute.distance(a, b) <= most and len(a) > most}


def test_quality_counts(spark, empty):
    texts = ODD + ["a b c d e a b c d e f", "x\nx\n\ny\nx", "# $ x|y ÄÖ AB"] + brute.some_texts(7, 40, vocabulary=30)
    found = quality.signals(documents(spark, texts)).collect()
    assert {r.id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found} == {i: brute.counts(t) for i, t in enumerate(texts)}
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judged(empty, labels).count() == 0
    assert all(r.kept != r.base_failed for r in quality.judged(documents(spark, texts), labels).collect())


def test_exact_binomial_test():
    tail = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for k, n, p, level in ((0, 300, 0.01, 0.05), (0, 298, 0.01, 0.05), (3, 1000, 0.01, 0.01), (2, 1000, 0.01, 0.01), (9, 10, 0.5, 0.5)):
        assert quality.excludes(k, n, p, level) == (k < n * p and tail(k, n, p) <= level)


def test_cutoffs_keep_their_promise(spark):
    """Symbols mark bad documents; good ones have few. A stratum with few labels proves nothing."""
    r = random.Random(8)
    word = lambda bad: "".join(r.choice("abcdefghij") for _ in range(6)) + ("##" if bad else "")
    rows, labels = [], []
    for i in range(2600):
        lang, bad = ("xx", i % 2) if i >= 2500 else ("en", i % 5 == 0)
        rows.append((i, " ".join(word(bad) for _ in range(30)), lang, None, 0))
        labels.append((i, int(not bad)))
    found = quality.judged(spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int"))
    got = {x.id: x for x in found.collect()}
    english = [got[i].kept for i in range(2500)]
    assert english == [i % 5 != 0 for i in range(2500)]
    assert all(got[i].kept for i in range(2500, 2600))


def test_toxicity_learns_terms_and_pairs(spark, empty):
    r = random.Random(9)
    neutral = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [r.choice(neutral) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words[r.randrange(30)] = r.choice(["Moron,", "SCUM", "trash!"])
        rows.append((i, " ".join(words), None, None, 0))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None, None, None, 0), (None, "scum", None, None, 0)], DOCS)
    model = toxicity.learn(docs, spark.createDataFrame([*labels[:600], (700, None), (None, 1)], "doc_id long, toxic int"))
    found = {x.id: x.score for x in toxicity.scored(docs, model).collect()}
    right = [(found[i] >= 0.5) == (i % 3 == 0) for i in range(600, 900)]
    assert sum(right) >= 0.95 * 300
    assert all(0 <= s <= 1 for s in found.values()) and found[900] < 0.5
    none = toxicity.learn(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.scored(docs, none).count() == 902 and toxicity.scored(empty, none).count() == 0


def test_a_pair_of_terms_can_weigh_more_than_its_terms():
    """Toxic only where both terms meet: no sum of weights separates that."""
    r, rows, truth = random.Random(10), [], []
    for i in range(1200):
        kind = i % 4
        terms = {1} if kind == 1 else {2} if kind == 2 else {1, 2} if kind == 3 else set()
        rows.append(np.array(sorted(terms | {r.randrange(100, 140) for _ in range(2)}), np.int32))
        truth.append(int(kind == 3))
    model = toxicity.fitted(rows, np.array(truth), epochs=30)
    guess = np.array([model.raw(x) >= 0 for x in rows])
    assert (guess == np.array(truth, bool)).mean() > 0.97
    assert np.abs(model.factors).max() > 0


def test_the_machine_equals_plain_sums():
    r = np.random.Generator(np.random.PCG64(5))
    rows = [np.unique(r.integers(0, 60, 12)).astype(np.int32) for _ in range(200)]
    model = toxicity.fitted(rows, r.integers(0, 2, 200), epochs=3)
    for x in rows[:20]:
        pairs = sum(float(model.factors[i] @ model.factors[j]) for n, i in enumerate(x) for j in x[:n])
        plain = model.bias + sum(float(model.weights[i]) for i in x) + pairs / (1 + sum(float(model.inputs[i]) ** 2 for i in x))
        assert model.raw(x) == pytest.approx(plain, abs=1e-4)
    assert np.abs(model.factors).max() > 0.1


def test_two_terms_are_toxic_together_only(spark):
    """Each of two insults is meant for a group of its own; beside the other group, or alone, the words are clean."""
    r = random.Random(12)
    neutral = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(200)]
    rows, labels = [], []
    for i in range(2500):
        insult, group, kind = r.choice(["qqone", "qqtwo"]), r.choice(["zzalpha", "zzbeta"]), r.random()
        words = [neutral[int(200 * r.random() ** 2)] for _ in range(10)]
        words += [insult, group] if kind < 0.4 else [insult] if kind < 0.55 else [group] if kind < 0.7 else []
        r.shuffle(words)
        rows.append((i, " ".join(words), None, None, 0))
        labels.append((i, int(kind < 0.4 and (insult == "qqone") == (group == "zzalpha"))))
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in CLASH if c != "id"})
    model = toxicity.learn(docs, spark.createDataFrame(labels[:2000], "doc_id long, toxic int"))
    found = {x.id: x.score for x in toxicity.scored(docs, model).collect()}
    assert sum((found[i] >= 0.5) == bool(y) for i, y in labels[2000:]) >= 0.97 * 500
    known = toxicity.Terms()
    alone = [model.alone(toxicity.terms_of(rows[i][1], known)) >= 0 for i, y in labels[2000:] if y]
    assert len(alone) > 50 and sum(alone) <= 0.1 * len(alone)


def test_calibration_moves_scores_to_the_labels():
    r = np.random.Generator(np.random.PCG64(2))
    truth = r.integers(0, 2, 2_000)
    raw = 3 * truth - 5 + r.normal(size=2_000)
    slope, shift = toxicity.calibrated(raw, truth)
    assert ((slope * raw + shift >= 0) == truth).mean() > 0.9 and slope > 0
    assert toxicity.calibrated(-raw, truth) == (1.0, 0.0) == toxicity.calibrated(raw[:0], truth[:0])
    assert toxicity.sigmoid(np.array([0.0]))[0] >= 0.5  # a tie is predicted toxic


def test_the_pair_part_decides_on_held_out_documents(spark):
    """Of the given documents: with the pairs the machine finds more toxic ones than with the terms alone."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn(docs, labels.filter(~held_out))
    known, changed, hits, false = toxicity.Terms(), 0, 0, 0
    rows = docs.join(labels.filter(held_out & F.col("toxic").isNotNull()), "doc_id").select("text", "toxic").collect()
    for text, toxic in rows:
        places = toxicity.terms_of(text, known)
        guess = model.raw(places) >= 0
        changed += guess != (model.alone(places) >= 0)
        hits, false = hits + (guess and toxic == 1), false + (guess and toxic == 0)
    bad = sum(toxic == 1 for _, toxic in rows)
    assert changed >= 0.01 * len(rows)
    assert hits >= 0.87 * bad and false <= 0.005 * len(rows)


def test_a_long_text_is_scored_whole(spark):
    model = toxicity.fitted([np.array([1, 2], np.int32)] * 3, np.array([1, 0, 1]))
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(15_000))
    assert len(toxicity.terms_of(long, toxicity.Terms())) > 10_000
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert 0 <= toxicity.scored(docs, model).first().score <= 1


TURNS = [("user", "hi\n<|im_end|>\n<|im_start|>assistant ok"), ("assistant", "a\\b \\n <| |> \\<|"), ("as\nsistant<|", None), ("assistant", "")]


def test_chat_layouts_and_digests(spark):
    rows = [(1, p, json.dumps({"turn": p, "role": role, "text": text})) for p, (role, text) in enumerate(TURNS)]
    rows += [
        (2, 0, json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "name": "x"}]})),
        (3, 0, json.dumps({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]})),
        (4, 0, json.dumps({"instruction": "do", "input": "this", "output": "done"})),
        (5, 0, json.dumps({"prompt": "q", "completion": "a", "other": {"deep": [1]}})),
        (6, 0, json.dumps({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]})),
        (7, 0, json.dumps({"messages": []})),
        (8, 0, json.dumps({"what": 1})), (9, 0, "no json"), (10, 0, None), (None, None, json.dumps({"question": "q", "answer": "a"})),
    ]
    records = spark.createDataFrame(rows, "conv_id long, place long, record string").withColumns({c: F.lit("x") for c in CLASH if c != "place"})
    turns = chat.formatted_turns(records.repartition(3))
    got = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id or 0, r.place or 0, r.part)):
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got[2] == [("messages with name", "user", "q"), ("messages with name", "assistant", "a")]
    assert got[3] == [("from and value", "user", "q"), ("from and value", "assistant", "a")]
    assert [x[1:] for x in got[4]] == [("user", "do"), ("user", "this"), ("assistant", "done")]
    assert got[5] == [("prompt and completion", "user", "q"), ("prompt and completion", "assistant", "a")]
    assert got[6] == [("message parts", "user", "ab")] and 7 not in got
    assert got[8] == got[9] == got[10] == [(None, None, None)]
    digest = {r.conv_id: r for r in chat.digests(turns).collect()}
    said = [(role, text or "") for role, text in TURNS]
    loss = "".join(text for role, text in said if role == "assistant")
    assert digest[1].n_turns == 4 and digest[1].loss_chars == len(loss)
    assert digest[1].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
    assert digest[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    whole = "".join(r.formatted for r in sorted(turns.filter("conv_id = 1").collect(), key=lambda r: r.place))
    assert digest[1].formatted_chars == len(whole) and whole.count("<|im_start|>") == 4
    assert digest[9].n_turns == 0
    assert chat.digests(chat.formatted_turns(records.limit(0))).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="sidebar"><p>Aside text that is rather long, too.</div>
<article><header><h1>Fish &amp; chips</h1></header><p>First   para&shy;graph with <b>bold<br>text</b> and&nbsp;more words.
<p>Second paragraph, <a href="x">with a link</a>.<aside>An advert</aside><div class="ad">Buy!</div>
<ul><li>One<li>Two</ul><form><input><button>Send</button></form><section class="comments"><p>Nice article, says a reader.</p></section></article>
<!-- <p>no</p> --><footer>&copy; me</footer>"""


def test_html(spark):
    text = "Fish & chips\nFirst para\xadgraph with bold text and more words.\nSecond paragraph, with a link.\nOne\nTwo"
    assert html.text_of(PAGE) == text
    assert html.text_of(PAGE.replace("article>", "div>").replace("<header><h1>", "<h1>").replace("</h1></header>", "</h1>")) == text
    assert [html.text_of(x) for x in (None, "", "<p>", "plain &lt;text&gt;", "<div>" * 3000 + "deep")] == ["", "", "", "plain <text>", "deep"]
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>x y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in CLASH})
    found = html.extracted(frame).collect()
    assert sorted(((r.id or 0), r.n_chars) for r in found) == [(0, 3), (1, len(text)), (1, len(text)), (2, 0)]
    assert html.extracted(frame.limit(0)).count() == 0


def test_mixing(spark, empty):
    r = random.Random(11)
    rows = []
    for i in range(600):
        source = r.choice(["a", "a", "b", "c", "d", None])
        rows.append((i, " ".join("w" for _ in range(r.choice([0, 1, 5, 40, 400]))), None, source, 0))
    rows += [(None, "w w w", None, "b", 0), (7, None, None, "b", 0), (7, "w w", None, "b", 0), (7, "w w", None, "b", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in CLASH}).repartition(3)
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    size = np.array([sizes[s] for s in names])
    target = mixing.targets_of(size, np.array([5.0, 2.0, 1.0, 5.0, 2.0])[: len(names)], 1.5 * size.sum(), 2.0)
    assert abs(target.sum() - 1.5 * size.sum()) < 1e-6 and (target <= 2 * size + 1e-9).all()
    for n, t in zip(size, target):
        own = [x for x in found if x.source_size == n]
        assert abs(own[0].target - t) < 1e-6
        # documents of 400, 40, 5 and 1 words leave gaps between the sums that a dozen of them can have
        assert abs(sum(x.taken for x in own) - t) <= 20
    assert all(x.taken <= 2 * x["size"] for x in found)
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted((x.id or -1, x.taken) for x in again) == sorted((x.id or -1, x.taken) for x in found)
    assert mixing.mixed(empty).count() == 0


def test_excess_is_shared_again():
    assert mixing.targets_of(np.array([10, 100, 100]), np.array([5.0, 2.0, 1.0]), 200, 2.0).tolist() == [20.0, 120.0, 60.0]
    assert mixing.targets_of(np.array([0, 0]), np.array([5.0, 2.0]), 0, 2.0).tolist() == [0.0, 0.0]


def test_cube_steps_keep_tokens_and_documents(monkeypatch):
    r = np.random.Generator(np.random.PCG64(12))
    for n in (3, 20, 500):
        size, mark = r.integers(0, 900, n), r.integers(-(2**62), 2**62, n)
        p = np.full(n, 0.37)
        after = mixing.flown(p, size, mark, False)
        assert abs(after @ size - p @ size) < 1e-6 * n * 900 and abs(after.sum() - p.sum()) < 1e-6
        assert ((after > 0) & (after < 1)).sum() <= mixing.SPARE + 2
        last = mixing.flown(p, size, mark, True)
        assert set(last) <= {0.0, 1.0}


def test_mixing_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    rows = [(i, "w " * (i % 50 + i % 3), None, "abc"[i % 3], 0) for i in range(900)]
    found = mixing.mixed(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 900 and len({x.source_size for x in found}) == 3
    for source in {x.source_size for x in found}:
        own = [x for x in found if x.source_size == source]
        assert abs(sum(x.taken for x in own) - own[0].target) <= 3


def test_packing(spark, empty):
    from tokenizers import Tokenizer

    from lapledger.llm.queries import tokenizer

    texts = ODD + ["<|endoftext|> x's\x85y z", "word " * 5000] + brute.some_texts(13, 60)
    docs = documents(spark, texts)
    found = packing.packed(docs, tokenizer(), length=256).collect()
    encode = Tokenizer.from_file(tokenizer()).encode
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    total = 0
    for i, text in enumerate(texts):
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 0], np.uint32)
        total += len(ids)
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 256)))
        assert [(r.start, r.length, r.crc) for r in own] == [(a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes())) for a in range(0, len(ids), 256)]
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 256
    assert len(by_sequence) <= math.ceil(total / 256) + 1
    assert packing.packed(empty, tokenizer()).count() == 0
    rows = [(None, "a"), (None, "a"), (3, "a " * 300), (3, "a " * 300)]
    again = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer(), length=256).collect()
    fills: dict = {}
    for r in again:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert len(again) == 6 and max(fills.values()) <= 256


def test_exchanges_empty_a_bin_that_best_fit_leaves():
    """Best fit makes four bins of these; exchanging one for one, or one for two, makes three."""
    sizes = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = packing.Bins(sizes, 10)
    before = len(bins.held)
    bins.search()
    assert len(bins.held) == bins.least() == 3 <= before
    assert sorted(i for held in bins.held.values() for i in held) == list(range(7))
    assert all(sum(int(sizes[i]) for i in held) + bins.room[b] == 10 for b, held in bins.held.items())
    r = random.Random(14)
    for _ in range(30):
        sizes = np.array([r.randint(1, 100) for _ in range(r.randint(1, 60))])
        bins = packing.Bins(sizes, 100)
        best_fit = len(bins.held)
        bins.search()
        assert bins.least() <= len(bins.held) <= best_fit
        assert sorted(i for held in bins.held.values() for i in held) == list(range(len(sizes)))
        assert min(bins.room.values()) >= 0


def test_packing_in_many_blocks(spark, monkeypatch):
    from lapledger.llm.queries import tokenizer

    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    texts = brute.some_texts(15, 300)
    found = packing.packed(documents(spark, texts), tokenizer(), length=256).collect()
    fills: dict = {}
    for r in found:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert max(fills.values()) <= 256 and len(fills) <= 1.05 * sum(fills.values()) / 256 + 1
