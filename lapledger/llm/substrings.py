"""Removal of repeated passages: seed and extend.

Seeds are winnowed anchors: of the 6-word runs inside each window of ``length`` words, the one with the smallest
hash (the leftmost of equals). Equal windows have the same anchor at the same place, so passages that repeat
share anchors. Documents meet on anchors found twice or more. Each anchor is extended both ways over all windows
that chose it: occurrences with the same extension are whole repeats of the first of them; where the extensions
differ, the windows inside are compared one by one. Repeated windows that touch are joined to maximal repeats.
Occurrences are compared with the first one, never with one another, so a passage in many documents costs as many
rows as it has occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf, chunks
from lapledger.llm.words import Words, mixed, random_table, run_hashes, word_hashes, words_of

ANCHOR = 6


class Ranges:
    """Hashes of any run of words, from sums of powers of an odd number."""

    def __init__(self, hashes: np.ndarray, seed: int):
        n = len(hashes)
        base = int(random_table(seed, 1)[0] | np.uint64(1))
        self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, pow(base, -1, 1 << 64), np.uint64)]))
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def anchors(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: its text's number, its hash, the first window that chose it, and the number of windows."""
    n = np.diff(words.bounds)
    runs = run_hashes(hashes, ANCHOR)
    width = length - ANCHOR + 1
    if len(runs) < width:
        return (np.zeros(0, np.int64),) * 4
    place = np.lib.stride_tricks.sliding_window_view(runs, width).argmin(1)
    text = np.repeat(np.arange(len(n)), np.maximum(n - length + 1, 0))
    first = np.cumsum(np.maximum(n - length + 1, 0)) - np.maximum(n - length + 1, 0)
    start = words.bounds[:-1][text] + np.arange(len(text)) - first[text]
    chosen = start + place[start]
    new = np.ones(len(text), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], runs[chosen[at]], start[at], np.diff(at, append=len(text))


def seeds(docs: DataFrame, length: int) -> DataFrame:
    """``anchor, extent`` (hashes), ``id, start, windows`` of each anchor of each document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                words = words_of(chunk.column(1))
                hashes = word_hashes(words)
                text, anchor, start, windows = anchors(words, hashes, length)
                extent = Ranges(hashes, 5).of(start, start + windows + length - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(extent.view(np.int64)),
                        chunk.column(0).take(pa.array(text)),
                        pa.array((start - words.bounds[text]).astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                    ],
                    ["anchor", "extent", "id", "start", "windows"],
                )

    return docs.mapInArrow(find, "anchor long, extent long, id long, start int, windows int")


def windows_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``w1, w2, id, start`` of the windows in ``wanted`` (id, start, windows)."""
    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("start", "windows")).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                words = words_of(chunk.column(1))
                ranges = chunk.column(2)
                flat, sizes = ranges.flatten(), np.diff(ranges.offsets.to_numpy())
                text = np.repeat(np.arange(len(sizes)), sizes)
                start, windows = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
                text, first = np.repeat(text, windows), np.repeat(start, windows)
                start = first + np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = words.bounds[text] + start
                sides = [Ranges(word_hashes(words, seed), seed + 10).of(at, at + length).view(np.int64) for seed in (3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, sides), chunk.column(0).take(pa.array(text)), pa.array(start.astype(np.int32))], ["w1", "w2", "id", "start"]
                )

    rows = docs.join(lists, "id").select("id", "text", "ranges")
    return rows.mapInArrow(cut, "w1 long, w2 long, id long, start int")


def later(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that are not the first (by id, then start) of those with the same keys."""
    first = rows.groupBy(*keys).agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("k"))
    return rows.join(first.filter("k > 1"), keys).filter("struct(id, start) != first")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20) -> DataFrame:
    """``id`` and ``spans`` (start, end) of the maximal runs of words covered by windows that also start earlier.

    Earlier is a smaller id, or the same id and a smaller start. Texts are read whole; a null or short text has
    no repeat; a null id takes no part. Rows that share an id share their places: a window is no repeat of one
    that starts at the same word of the same id, and what is a repeat in one of them is one in all.
    """
    if length < ANCHOR:
        raise ValueError(f"length must be {ANCHOR} at least")
    shelf = Shelf(docs.sparkSession, "substrings")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    found = shelf.put(seeds(rows, length), "seeds")
    met = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("anchor")
    shared = shelf.put(found.join(met, "anchor"), "shared")
    shelf.drop("seeds")
    whole = later(shared, ["anchor", "extent"]).select("id", "start", F.expr("start + windows - 1").alias("last"))
    firsts = shared.groupBy("anchor", "extent").agg(F.min(F.struct("id", "start", "windows")).alias("first"))
    mixed_anchors = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("extents")).filter("extents > 1").select("anchor")
    open_ = firsts.join(mixed_anchors, "anchor").select("first.*").distinct()
    windows = shelf.put(windows_of(rows, open_, length), "windows")
    single = later(windows, ["w1", "w2"]).select("id", "start", F.col("start").alias("last"))
    ranges = whole.union(single).groupBy("id").agg(F.collect_list(F.struct("start", "last")).alias("ranges"))
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for own in batch.column(1).to_pylist():
                done: list[list[int]] = []
                for start, last in sorted((r["start"], r["last"]) for r in own):
                    if done and start <= done[-1][1]:
                        done[-1][1] = max(done[-1][1], last + length)
                    else:
                        done.append([start, last + length])
                spans.append([{"start": x, "end": y} for x, y in done])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    return ranges.mapInArrow(merge, "id long, spans array<struct<start:int,end:int>>")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20) -> DataFrame:
    """``id, n_words, n_removed, text`` of every row: its words without those in repeats, joined by one space."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    joined = rows.join(repeats(docs, id_col, text_col, length), "id", "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                words = words_of(chunk.column(1))
                data, total, gone, texts = words.data, [], [], []
                for i, spans in enumerate(chunk.column(2).to_pylist()):
                    a, b = words.bounds[i], words.bounds[i + 1]
                    left = np.ones(b - a, bool)
                    for span in spans or ():
                        left[span["start"] : span["end"]] = False
                    own = data[words.text_starts[i] : words.text_starts[i + 1]].tobytes()
                    base = words.text_starts[i]
                    kept = [own[s:e] for s, e, k in zip(words.starts[a:b] - base, words.ends[a:b] - base, left) if k]
                    total.append(int(b - a))
                    gone.append(int(b - a) - len(kept))
                    texts.append(b" ".join(kept).decode())
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                    ["id", "n_words", "n_removed", "text"],
                )

    return joined.select("id", "text", "spans").mapInArrow(keep, "id long, n_words long, n_removed long, text string")
