"""Files of token ids: exact round trips and the public tokenizer."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from test_operators import CLASH, DOCS, ODD
from pyspark.sql import functions as F

from lapledger.llm import token_files
from lapledger.llm.queries import QUERIES, tokenizer
from lapledger.session import new_path


@pytest.mark.parametrize("n", [0, 1, 2, 59, 60, 61, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("most", [1, 2, 7, 100, 49_152, 2**32, 2**60, 2**64])
def test_round_trip(n, most):
    random = np.random.Generator(np.random.PCG64(n))
    for zeros in (0.0, 0.9):
        ids = random.integers(0, most, n, dtype=np.uint64, endpoint=False) if most < 2**64 else random.integers(0, 2**64, n, dtype=np.uint64)
        ids[random.random(n) < zeros] = 0
        words, offsets, escapes = token_files.encode(ids)
        assert (token_files.decode(words, offsets, escapes, n) == ids).all()
        assert len(offsets) == -(-n // token_files.BLOCK) + 1


def test_words_hold_as_many_ids_as_fit():
    words, offsets, escapes = token_files.encode(np.zeros(240, np.uint64))
    assert len(words) == 2 and not len(escapes)
    words, _, _ = token_files.encode(np.ones(120, np.uint64))
    assert list(words >> np.uint64(60)) == [1, 1]
    words, _, _ = token_files.encode(np.full(12, 49_151, np.uint64))
    assert len(words) == 4  # three of 20 bits each; 16 bits do not fit a pack of 15
    words, _, escapes = token_files.encode(np.array([2**63, 5, 2**60], np.uint64))
    assert list(escapes) == [2**63, 2**60] and len(words) == 3


@pytest.mark.parametrize("bits", [1, 4, 9, 16, 40, 64])
def test_selectors_are_the_first_that_fit(bits):
    """Blocks are looked at side by side; each place is told the pack that holds most of the ids behind it."""
    random = np.random.Generator(np.random.PCG64(bits))
    n = token_files.BLOCK + 300
    ids = random.integers(0, 2**63, n, dtype=np.uint64) >> random.integers(64 - bits, 64, n).astype(np.uint64)
    packs = [(token_files.ZEROS, 0), *token_files.PACKS]

    def first(at):
        end = min((at // token_files.BLOCK + 1) * token_files.BLOCK, n)
        return next((k for k, (count, wide) in enumerate(packs) if int(ids[at : min(at + count, end)].max()) < 1 << wide), token_files.ESCAPE)

    assert token_files._selectors(ids).tolist() == [first(at) for at in range(n)]


def test_a_block_is_decoded_alone():
    ids = np.random.Generator(np.random.PCG64(1)).integers(0, 50_000, 3_000).astype(np.uint64)
    words, offsets, escapes = token_files.encode(ids)
    part = words[offsets[1] : offsets[2]]
    alone = token_files.decode(part, np.array([0, len(part)]), escapes, token_files.BLOCK)
    assert (alone == ids[token_files.BLOCK : 2 * token_files.BLOCK]).all()


def expected(rows):
    from tokenizers import Tokenizer

    known, at, found = Tokenizer.from_file(tokenizer()), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*known.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def test_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 700)
    monkeypatch.setattr(token_files, "FILE_FRAMES", 2)
    r = random.Random(2)
    texts = ODD + [" ".join(r.choice(["The", "house,", "é", "Ünder", "a1", "\n", "x!?"]) for _ in range(r.randint(0, 300))) for _ in range(60)]
    texts.append("long text. " * 20_000)
    rows = [(i * 3 % 71, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, "no id"), (2**62, "far"), (-5, "below")]
    frame = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).withColumns({c: F.lit("x") for c in CLASH}).repartition(5)
    path = new_path(spark, "files")
    token_files.write(frame, tokenizer(), path)
    found = token_files.read(spark, path).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    assert [(x.id, x.start, x.n_tokens, x.crc) for x in found] == expected(rows)
    assert all(len(x.ids) == 4 * x.n_tokens for x in found)
    assert token_files.files(spark, path).filter("piece > 0").count()


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(7, "one"), (7, "two words"), (7, "one"), (3, None)]
    path = new_path(spark, "files")
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tokenizer(), path)
    found = token_files.read(spark, path).orderBy("start").collect()
    assert [(x.id, x.start) for x in found] == [r[:2] for r in expected(rows)]


def test_no_rows_make_no_documents(spark):
    path = new_path(spark, "files")
    token_files.write(spark.createDataFrame([], DOCS), tokenizer(), path)
    assert token_files.read(spark, path).count() == 0


def test_the_query_reads_whole_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_token_output"](spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected(rows)
