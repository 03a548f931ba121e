from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lapledger.llm import queries

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives on the smallest tables."""
    root, results = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(root / str(number)))
        after = spark.read.parquet(str(root / str(number)))
        results.append((docs, after))
        docs = after
    return results


def test_stage_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing",
    ]
    assert all(set(after.columns) == DOCUMENTS for _, after in stages[:-1])


def test_quality_rules_drop_what_the_base_rejects(stages):
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in stages[0])
    failed = {i for i, t in before.items() for n, *_, again in [brute.counts(t)] if n < 10 or 100 * again > 20 * n}
    # with so few labels no other rule can be proven, so all others stay
    assert set(after) == set(before) - failed


def test_lines_are_removed(stages):
    before, after = ({r.doc_id: r for r in x.collect()} for x in stages[1])
    gone = brute.removed_lines([(i, r.text) for i, r in before.items()])
    assert set(before) == set(after) and gone
    for i, r in after.items():
        assert r.text == "\n".join(x for p, x in enumerate(before[i].text.split("\n")) if p not in gone.get(i, ()))
        assert r.n_chars == len(r.text)


def test_one_document_of_each_group_stays(stages):
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in stages[2])
    found = brute.similar(list(before.items()), 5, 80)
    assert set(after) == {i for i, _, component in found if i == component}


def test_mix_repeats_or_drops_whole_documents(stages):
    before, after = ([(r.doc_id, r.text) for r in x.collect()] for x in stages[3])
    assert set(after) <= set(before)
    words = sum(len(brute.WORD.findall(t or "")) for _, t in before)
    assert abs(sum(len(brute.WORD.findall(t or "")) for _, t in after) - 1.5 * words) < 0.05 * words
    assert max(after.count(x) for x in after) <= 2


def test_all_documents_are_packed(stages):
    docs, pieces = (x.collect() for x in stages[4])
    assert sorted(r.doc_id for r in pieces if r.piece == 0) == sorted(r.doc_id for r in docs)
    fills: dict = {}
    for r in pieces:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert max(fills.values()) <= 2048 and len(fills) <= sum(fills.values()) / 2048 + 2


def test_run_is_all_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == stages[-1][1].count()


def test_stages_take_empty_tables_and_nulls(spark, tmp_path):
    """An empty table stays empty, and rows of nulls go through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for number, rows in enumerate(([], [(None, None, None, None, None), (1, None, None, None, 0), (2, " ".join(f"w{i}" for i in range(80)), None, None, 0), (None, " ".join(f"x{i}" for i in range(80)), None, "s", 0)])):
        docs = spark.createDataFrame(rows, schema)
        for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{number}-{step}")
            stage(spark, docs, SF_DIR).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(rows)


def test_rows_without_an_id_meet_all_rules(spark, tmp_path):
    """Junk goes, of copies the one with an id stays, and other columns go."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [" ".join(f"{k}{i}" for i in range(60)) for k in "abc"]
    rows = [(None, texts[0], "en", "s", 1), (5, texts[0], "en", "s", 1), (None, texts[1], "en", "s", 1), (None, texts[1], "en", "s", 1), (None, "junk", "en", "s", 1), (6, texts[2], "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name in ("id", "h", "key", "token", "place", "component", "block", "size", "taken", "copies", "kept"):
        docs = docs.withColumn(name, F.lit("x"))
    nameless, after = corpus_pipeline.NAMELESS, []
    for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(step))
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        if step < 4:
            assert set(docs.columns) == DOCUMENTS
            after.append(sorted((min(r.doc_id, nameless), r.text) for r in docs.select("doc_id", "text").collect()))
    assert after[0] == [(5, texts[0]), (6, texts[2]), (nameless, texts[0]), (nameless, texts[1]), (nameless, texts[1])]
    # the line of a text stays where it has an id, and once where it has none
    assert after[1] == after[2] == [(5, texts[0]), (6, texts[2]), (nameless, ""), (nameless, ""), (nameless, texts[1])]
    assert {r.doc_id for r in docs.collect()} <= {5, 6, None} and docs.filter("doc_id is null").count()


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
