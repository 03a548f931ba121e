"""Ranked lexical search for many items at once, by dual-tree search.

The items of a block and the documents of a batch are split into hierarchies. Each node holds, for each term, the
largest value of its members: of items the weight times the repeats, of documents what the term's frequency counts
for. The product of two nodes' maxima bounds the score of each of their pairs. Pairs of nodes are taken from the
largest bound on; where the bound is below the weakest last score that the node's items have so far, all pairs of
the two nodes are left out at once. What is left is scored exactly, in integers. Each task keeps its best documents
of each item, and the best of these are the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf, chunks
from lapledger.llm.words import word_hashes, words_of

#: What stands between terms, as bytes: all of ASCII but digits and letters.
BETWEEN = tuple(b for b in range(128) if not chr(b).isalnum())
#: Rows of ``items`` that are searched for at once, at most; their terms are what is sent to the tasks.
BLOCK_ITEMS = 512
#: Members of a leaf, and the most cells of a matrix of items, or of a batch of documents, by terms.
ITEM_LEAF, DOC_LEAF, CELLS = 4, 16, 1 << 23
BATCH_DOCS = 4_096
#: Sums below this are exact in doubles.
EXACT = 1 << 53
#: A bound is a sum of doubles; it is raised by more than its rounding.
SLACK = 1 + 1e-9
BEST = 10


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each term, and the terms before each text and in all."""
    words = words_of(texts, lower=True, separators=BETWEEN)
    return word_hashes(words, separators=BETWEEN).view(np.int64), words.bounds


def counted(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``id, n, places, times`` of each row: its terms with repeats, and which of the vocabulary it holds how often."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for chunk in chunks(batch, "text"):
                hashes, bounds = term_hashes(chunk.column(1))
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                held = known[place] == hashes
                cells, times = np.unique(doc[held] * len(known) + place[held], return_counts=True)
                at = np.searchsorted(cells, np.arange(len(bounds)) * len(known))
                places, times = (cells % len(known)).astype(np.int32), times.astype(np.int32)
                each = lambda values: pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(np.diff(bounds)), each(places), each(times)], ["id", "n", "places", "times"])

    return docs.mapInArrow(count, "id long, n long, places binary, times binary")


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """How many rows hold each term of the vocabulary; summed up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for places in batch.column(0):
                total[np.frombuffer(places.as_buffer(), np.int32)] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "rows"])

    result = np.zeros(size, np.int64)
    for row in found.select("places").mapInArrow(count, "place long, rows long").groupBy("place").agg(F.sum("rows").alias("rows")).collect():
        result[row.place] = row.rows
    return result


class Tree:
    """A hierarchy over the rows of a matrix: split by the term that nearest to half of a node's rows have."""

    def __init__(self, values: np.ndarray, leaf: int):
        has = values > 0
        self.rows, self.children = [np.arange(len(values))], []
        node = 0
        while node < len(self.rows):
            rows = self.rows[node]
            if len(rows) <= leaf:
                self.children.append(())
            else:
                share = has[rows].sum(0)
                column = int(np.argmin(np.abs(2 * share - len(rows))))
                inside = has[rows, column]
                if not 0 < share[column] < len(rows):
                    inside = np.arange(len(rows)) < len(rows) // 2
                self.children.append((len(self.rows), len(self.rows) + 1))
                self.rows += [rows[inside], rows[~inside]]
            node += 1
        self.most = np.zeros((len(self.rows), values.shape[1]))
        for node in range(len(self.rows) - 1, -1, -1):
            below = self.children[node]
            self.most[node] = np.maximum(*self.most[list(below)]) if below else values[self.rows[node]].max(0)


class Best:
    """The best documents of each item so far: highest score, then smallest id, null last."""

    def __init__(self, items: int, most: int):
        self.most, self.last = most, np.zeros(items, np.int64)
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        enough = np.flatnonzero((scores > 0) & (scores >= self.last[item]))
        if len(enough):
            new = [(-int(scores[i]), bool(nulls[i]), int(ids[i])) for i in enough]
            self.found[item] = sorted(self.found[item] + new)[: self.most]
            if len(self.found[item]) == self.most:
                self.last[item] = -self.found[item][-1][0]


def search(items: Tree, weights: np.ndarray, values: np.ndarray, ids: np.ndarray, nulls: np.ndarray, best: Best) -> int:
    """Bring ``best`` up to date with these documents; returns how many pairs were scored."""
    docs = Tree(values, DOC_LEAF)
    bounds = items.most @ docs.most.T * SLACK
    exact = float(weights.sum(1, dtype=np.float64).max()) * float(values.max()) < EXACT
    kind = np.float64 if exact else np.int64
    scored, queue = 0, [(-bounds[0, 0], 0, 0)]
    while queue:
        bound, i, d = heapq.heappop(queue)
        members = items.rows[i]
        if bound == 0 or -bound < best.last[members].min():
            continue
        ours, theirs = items.children[i], docs.children[d]
        if not ours and not theirs:
            rows = docs.rows[d]
            scores = (weights[members].astype(kind) @ values[rows].astype(kind).T).astype(np.int64)
            scored += scores.size
            for item, row in zip(members, scores):
                best.add(item, row, ids[rows], nulls[rows])
            continue
        # the larger of the two is split
        split = bool(theirs) and (not ours or len(docs.rows[d]) >= len(members))
        for x, y in ([(i, c) for c in theirs] if split else [(c, d) for c in ours]):
            if bounds[x, y] > 0:
                heapq.heappush(queue, (-bounds[x, y], x, y))
    return scored


def _dense(batch: pa.RecordBatch, size: int, total: tuple[int, int]) -> np.ndarray:
    """What each term of the vocabulary counts for in each document."""
    documents, terms = total
    values = np.zeros((batch.num_rows, size), np.int32)
    for row, (n, places, times) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3))):
        tf = np.frombuffer(times.as_buffer(), np.int32).astype(np.int64)
        length = 100 - 75 + (75 * n * documents) // terms
        values[row, np.frombuffer(places.as_buffer(), np.int32)] = (1_000_000_000 * tf) // (1000 * tf + 8 * length)
    return values


Item = tuple[int, np.ndarray, np.ndarray]


def matrices(items: list[Item]) -> Iterator[tuple[list[Item], np.ndarray]]:
    """The items (number, terms, times) in runs with their terms, of which a matrix of items by terms has at most CELLS (or one item)."""
    run, terms = [], np.zeros(0, np.int64)
    for item in items:
        more = np.union1d(terms, item[1])
        if run and (len(run) + 1) * len(more) > CELLS:
            yield run, terms
            run, more = [], np.unique(item[1])
        run.append(item)
        terms = more
    if run:
        yield run, terms


def _run(found: DataFrame, cells: list[tuple[np.ndarray, np.ndarray]], numbers: list[int], size: int, total: tuple[int, int], best: int) -> DataFrame:
    """``number, id, score``: the best documents of each item in each task. ``cells`` are the places and weights of its terms."""
    sent = found.sparkSession.sparkContext.broadcast(cells)
    step = max(1, min(BATCH_DOCS, CELLS // size))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((len(sent.value), size), np.int64)
        for row, (places, values) in zip(own, sent.value):
            row[places] = values
        items, kept = Tree(own, ITEM_LEAF), Best(len(own), best)
        for batch in batches:
            # documents that hold no term of the items have no score
            batch = batch.filter(pa.compute.greater(pa.compute.binary_length(batch.column(2)), 0))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                nulls = np.array(part.column(0).is_null())
                search(items, own, _dense(part, size, total), np.array(part.column(0).fill_null(0)), nulls, kept)
        rows = [(numbers[i], None if null else doc, -minus) for i, x in enumerate(kept.found) for minus, null, doc in x]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], ["number", "id", "score"])

    return found.mapInArrow(score, "number long, id long, score long")


def item_terms(rows: DataFrame) -> DataFrame:
    """``number, terms, times`` of each item: its different terms (hashes in order) and their repeats."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                hashes, bounds = term_hashes(chunk.column(1))
                each = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
                blobs = [pa.array([x[k].astype(np.int64).tobytes() for x in each], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([chunk.column(0), *blobs], ["number", "terms", "times"])

    return rows.select("number", "text").mapInArrow(hashed, "number long, terms binary, times binary")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    best: int = BEST,
) -> DataFrame:
    """``item, rank, id, score`` of the ``best`` documents of each row of ``items`` that score above 0.

    Ranks are 1 and on, by score, then smallest id; a null id comes last among equal scores. Each row of ``docs``
    is a document and each row of ``items`` an item of its own, also where ids repeat. Null and empty texts have no
    terms: such a document has no score, such an item no rows. Terms are told apart by 64-bit hashes. Items are
    searched for in blocks of BLOCK_ITEMS rows and CELLS cells at most, each against all documents.
    """
    spark: SparkSession = docs.sparkSession
    shelf = Shelf(spark, "search")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    asked = shelf.put(asked.withColumn("number", F.monotonically_increasing_id()), "items")
    terms = shelf.put(item_terms(asked).withColumn("block", F.floor(F.col("number") / BLOCK_ITEMS)), "terms")

    parts, total = [], None
    for (block,) in sorted(terms.filter(F.length("terms") > 0).select("block").distinct().collect()):
        held = terms.filter((F.col("block") == block) & (F.length("terms") > 0)).orderBy("number").collect()
        each = [(r.number, np.frombuffer(r.terms, np.int64), np.frombuffer(r.times, np.int64)) for r in held]
        for run, vocabulary in matrices(each):
            found = shelf.put(counted(rows, vocabulary), "counted")
            if total is None:
                total = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
            if not total.documents:
                break
            df = frequencies(found, len(vocabulary)).tolist()
            own = np.array([math.floor(1000 * math.log((2 * total.documents + 2) / (2 * x + 1))) for x in df], np.int64)
            places = [np.searchsorted(vocabulary, t).astype(np.int32) for _, t, _ in run]
            cells = [(at, own[at] * times) for at, (_, _, times) in zip(places, run)]
            numbers = [number for number, *_ in run]
            parts.append(shelf.put(_run(found, cells, numbers, len(vocabulary), (total.documents, total.terms), best), "best"))
            shelf.drop("counted")
    if not parts:
        parts = [spark.createDataFrame([], "number long, id long, score long")]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranks = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranks.join(asked.select("number", "item"), "number").select("item", "rank", "id", "score")
