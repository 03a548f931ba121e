"""What a worker remembers of words is bounded, and forgetting changes no token."""

from __future__ import annotations

import random

from lapledger.llm import packing
from lapledger.llm.queries import tokenizer
from lapledger.llm.tables import BATCH_ROWS


def test_full_tables_give_way_and_tokens_stay_the_same():
    drawn = random.Random(7)
    words = ["".join(drawn.choices("abcdeéß", k=drawn.randint(1, 9))) for _ in range(400)]
    words += [w.capitalize() + drawn.choice(["", ",", ".", "?!"]) for w in words] + ["İx", "3.5", "x|y"]
    known = packing.Tokens(tokenizer(), 50, 40)
    plain = known.tokenizer
    for _ in range(300):
        text = " ".join(drawn.choices(words, k=20))
        ids = plain.encode(text, add_special_tokens=False).ids
        assert known.of(text) == packing.array("I", ids).tobytes()
        assert len(known) <= 51 and len(known.known) <= 40 and len(known.earlier) <= 40
    assert len(known.earlier) == 40


def test_documents_reach_tasks_in_small_batches(spark, monkeypatch):
    seen, put = [], packing.Shelf.put

    def watched(self, df, name):
        seen.append((name, int(self.spark.conf.get(BATCH_ROWS))))
        return put(self, df, name)

    monkeypatch.setattr(packing.Shelf, "put", watched)
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert packing.packed(docs, tokenizer()).count() == 2
    assert dict(seen)["pieces"] == packing.BATCH_DOCS == 1_000
    assert packing.WORDS + 2 * packing.PLAIN_WORDS <= 600_000
