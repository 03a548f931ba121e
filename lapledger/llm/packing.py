"""Packing of tokenized documents into sequences of a fixed length, by swap-based local search.

Each block of pieces starts from best fit, longest first. Then the emptiest bin is emptied into the others: a
piece moves where it fits, or changes places with one or two shorter pieces of a fuller bin. Each exchange raises
the sum of squared fills, so the search ends; a bin that has lost all its pieces is gone. Bins that a block leaves
underfull are dissolved and packed again with those of other blocks.
"""

from __future__ import annotations

import math
import sys
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf, chunks, rows_per_batch

LENGTH = 2_048
BLOCK_ROWS = 20_000
#: Of a block's bins, those filled less than this share go to the next round, the emptiest eighth at most.
FULL, PASSED_ON = 0.98, 8
#: Rows that tasks are sent at a time.
BATCH_DOCS = 1_000
#: Words that a worker remembers the tokens of as they are written, and words without marks and capitals, the latter
#: from the last two tables of this size.
WORDS, PLAIN_WORDS = 100_000, 250_000
MARKS = ".,!?;:|#%&$*)"
#: Letters below this are composed, have one lower case each, and need no normalization (but for the dotted I).
PLAIN, DOTTED = "\u0250", "\u0130"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is visible, else the next free one."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Tokens(dict):
    """Token ids of a word as little-endian 32-bit numbers, remembered.

    Tokens never reach over a space or a line feed, nor from letters to marks. So a word of plain letters, with or
    without marks behind it, is looked up by its letters in lower case; any other word is given to the tokenizer.
    """

    def __init__(self, path: str, words: int, plain_words: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.words, self.plain_words = Tokenizer.from_file(path), words, plain_words
        self.model, self.letters, self.known, self.earlier = self.tokenizer.model, byte_letters(), {}, {}

    def _letters(self, word: str) -> bytes:
        if (found := self.known.get(word)) is None:
            if len(self.known) >= self.plain_words:
                # common words come back from the earlier table, the many that occur once go
                self.known, self.earlier = {}, self.known
            if (found := self.earlier.get(word)) is None:
                told = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
                found = array("I", [t.id for t in self.model.tokenize(told)]).tobytes()
            self.known[word] = found
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.words:
            self.clear()
        head = word.rstrip(MARKS)
        if head.isalpha() and max(head) < PLAIN and DOTTED not in head:
            ids = self._letters(head.lower())
            if head != word:
                ids += self[word[len(head) :]]
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def tokens(path: str, words: int = WORDS, plain_words: int = PLAIN_WORDS) -> Tokens:
    """A worker outlives its tasks, and functions come anew with each: what it remembers is kept with the process."""
    kept = sys.__dict__.setdefault("_lapledger_tokens", {})
    key = (path, words, plain_words)
    if key not in kept:
        kept[key] = Tokens(*key)
    return kept[key]


def pieces(docs: DataFrame, path: str, length: int, end: int) -> DataFrame:
    """``id, piece, start, length, crc, mark`` of each document's pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens(path)
        stop = np.array([end], np.uint32).tobytes()
        for batch in batches:
            for chunk in chunks(batch, "text"):
                out: list[tuple] = []
                for doc, text, mark in zip(*(c.to_pylist() for c in chunk.columns)):
                    ids = known.of(text or "") + stop
                    for k, at in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[at : at + 4 * length]
                        out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), mark))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["id", "piece", "start", "length", "crc", "mark"])

    rows = docs.withColumn("mark", F.xxhash64("id", "text")).select("id", "text", "mark")
    return rows.mapInArrow(cut, "id long, piece int, start long, length long, crc long, mark long")


class Bins:
    """Bins of pieces, known by number and size."""

    def __init__(self, sizes: np.ndarray, length: int):
        self.sizes, self.length = sizes.tolist(), length
        self.held: dict[int, list[int]] = {}
        self.room: dict[int, int] = {}
        self._best_fit()

    def _best_fit(self) -> None:
        open_: list[list[int]] = [[] for _ in range(self.length + 1)]
        some = 0  # bit r: a bin with room r
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[i]
            fits = some >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = open_[room].pop()
                if not open_[room]:
                    some &= ~(1 << room)
                self.held[b].append(i)
            else:
                room, b = self.length, len(self.held)
                self.held[b] = [i]
            room -= size
            self.room[b] = room
            open_[room].append(b)
            some |= 1 << room

    def least(self) -> int:
        """No packing has fewer bins than this."""
        return math.ceil(sum(self.sizes) / self.length)

    def _swap(self, a: int, b: int, out: list[int], back: list[int]) -> None:
        """``out`` goes from bin a to b, ``back`` from b to a."""
        for i in out:
            self.held[a].remove(i)
        for i in back:
            self.held[b].remove(i)
        self.held[a] += back
        self.held[b] += out
        gain = sum(self.sizes[i] for i in out) - sum(self.sizes[i] for i in back)
        self.room[a] += gain
        self.room[b] -= gain

    def _improve(self, a: int) -> bool:
        """One exchange that takes tokens out of bin a into a fuller one."""
        for i in sorted(self.held[a], key=lambda i: -self.sizes[i]):
            size = self.sizes[i]
            for b in sorted((b for b in self.room if b != a and self.room[b] and self.room[b] <= self.room[a]), key=lambda b: -self.room[b]):
                room = self.room[b]
                if room >= size:
                    self._swap(a, b, [i], [])
                    return True
                inside = sorted((self.sizes[j], j) for j in self.held[b])
                # one for one, then two for one: as little as possible comes back
                at = bisect_left(inside, (size - room, -1))
                if at < len(inside) and inside[at][0] < size:
                    self._swap(a, b, [i], [inside[at][1]])
                    return True
                low, high, best = 0, len(inside) - 1, None
                while low < high:
                    pair = inside[low][0] + inside[high][0]
                    if pair >= size - room:
                        if pair < size and (best is None or pair < best[0]):
                            best = (pair, inside[low][1], inside[high][1])
                        high -= 1
                    else:
                        low += 1
                if best:
                    self._swap(a, b, [i], list(best[1:]))
                    return True
        return False

    def search(self) -> None:
        """Empty the emptiest bin, again and again, while fewer bins are possible and exchanges are left."""
        while len(self.held) > self.least():
            a = max(self.held, key=lambda b: (self.room[b], b))
            while self.held[a] and self._improve(a):
                pass
            if self.held[a]:
                return
            del self.held[a], self.room[a]


def packed(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = 0
) -> DataFrame:
    """``id, piece, start, length, crc, sequence_id, offset`` of each piece of each row.

    A document is the ids of its text and ``end``; null and empty texts are ``end`` alone. Only documents longer
    than a sequence are cut. Rows that repeat are packed each; null ids too. ``path`` names a tokenizer's file
    that every executor has.
    """
    shelf = Shelf(docs.sparkSession, "packing")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with rows_per_batch(docs.sparkSession, BATCH_DOCS):
        cut = shelf.put(pieces(rows, path, length, end), "pieces")
    whole = F.col("length") == length
    # a full piece is a sequence of its own
    full = cut.filter(whole).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    columns = [*cut.columns, "sequence_id", "offset"]

    def fill(turn: int):
        def work(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
            block = block.sort_values(["length", "mark", "piece"], ascending=False).reset_index(drop=True)
            bins = Bins(block.length.to_numpy(), length)
            bins.search()
            sequence, offset = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
            emptiest = sorted(bins.held, key=lambda b: -bins.room[b])[: math.ceil(len(bins.held) / PASSED_ON)]
            passed_on = {b for b in emptiest if bins.room[b] > (1 - FULL) * length}
            for number, (b, held) in enumerate(sorted(bins.held.items())):
                at = 0
                for i in held:
                    sequence[i], offset[i] = (turn << 56) | (int(key[0]) << 20) | number, at
                    at += bins.sizes[i]
                if b in passed_on:
                    offset[held] = -1 - offset[held]
            return block.assign(sequence_id=sequence, offset=offset)[[*columns, "block"]]

        return work

    done, waiting, turn = full, cut.filter(~whole), 1
    while True:
        n = max(1, math.ceil(waiting.count() / BLOCK_ROWS))
        blocks = waiting.withColumn("block", F.pmod(F.xxhash64("mark", "piece", F.lit(turn)), F.lit(n)))
        schema = ", ".join(f"{c} {t}" for c, t in [*cut.dtypes, ("sequence_id", "long"), ("offset", "long"), ("block", "long")])
        filled = shelf.put(blocks.groupBy("block").applyInPandas(fill(turn), schema).drop("block"), "round")
        if n == 1:
            # the last round's bins stay as they are
            done = done.unionByName(filled.withColumn("offset", F.when(F.col("offset") < 0, -1 - F.col("offset")).otherwise(F.col("offset"))))
            break
        done = done.unionByName(filled.filter("offset >= 0"))
        waiting, turn = filled.filter("offset < 0").select(*cut.columns), turn + 1
    return done.select("id", "piece", "start", "length", "crc", "sequence_id", "offset")
