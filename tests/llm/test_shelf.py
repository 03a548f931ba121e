"""Tables on the way go as soon as nothing reads them: what a lazy result keeps is what it reads."""

from __future__ import annotations

from pathlib import Path

from lapledger.llm import line_dedup, ngram_join
from lapledger.session import shared_folder

WORDS = [f"word{i} and{i % 7}" for i in range(60)]


def paths(spark):
    return set(Path(shared_folder(spark).removeprefix("file:")).iterdir())


def names(found):
    """Names of tables without the random end of their paths."""
    return {p.name.rsplit("-", 1)[0] for p in found}


def frame(spark, make):
    return spark.createDataFrame([(i, make(i)) for i in range(24)], "doc_id long, text string")


def test_ngram_join_keeps_sizes_and_components(spark):
    # pairs of documents with one word changed
    docs = frame(spark, lambda i: " ".join([*WORDS[i // 2 :], *WORDS[: i // 2], *(["x"] if i % 2 else [])]) + f" {i // 2}")
    before = paths(spark)
    found = ngram_join.similar(docs, width=4, percent=85)
    assert names(paths(spark) - before) <= {"ngrams-own", "ngrams-edges"}
    assert found.count() == 24 and found.filter("id != component_id").count() > 0


def test_line_dedup_keeps_places_and_components(spark):
    docs = frame(spark, lambda i: f"the line of many words is number {i // 2} of all{'s' if i % 2 else ''}\nshort")
    before = paths(spark)
    found = line_dedup.removals(docs)
    assert names(paths(spark) - before) <= {"lines-placed", "lines-classes", "lines-edges"}
    assert found.count() == 24 and found.filter("size(removed) > 0").count() > 0
