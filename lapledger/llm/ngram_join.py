"""Similarity join of documents on word shingles, by adaptive multi-match prefixes.

Shingles have one order for all documents: from rare to frequent, by the number of documents that hold them, ties
by hash. They are counted in buckets of their hashes, to which tasks send them in arrays, once for each chunk of
documents; each bucket answers a chunk with a byte for each of its shingles. Two sets with similarity over the threshold share at least ``m`` shingles within the
first ``n - least overlap + m`` of either. So the first shingles of each set are its prefix; a set whose prefix
would meet many others takes a longer one and asks for more shared shingles, whichever costs least by the
counts of its own prefix. Pairs with enough shared shingles are verified on the whole sets.

Components do not need all links: sets that share a shingle are first tried against the set that has fewest
shingles of its own among them, and only pairs of sets that are in different components by then are listed. A
large group of copies so costs as many pairs as it has members. The result is the same as that of all pairs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.llm.links import components
from lapledger.llm.tables import Shelf, chunks, rows_per_batch
from lapledger.llm.words import mixed, run_hashes, word_hashes, words_of

#: Shingles of a bucket in which they are counted.
BUCKET = 500_000
#: Bytes of text of a chunk of sets. Rows of these, and of texts, that are sent to a task at a time.
CHUNK_BYTES, CHUNKS, TEXTS = 1_000_000, 8, 1_000
#: The level of a shingle that one document alone holds.
ALONE = 0
#: The most shared shingles that a prefix may ask for, and the cost of verifying a pair in rows of a posting list.
MATCHES, VERIFY_COST = 4, 20


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words than ``width`` is one shingle."""
    words = words_of(texts, lower=True)
    hashes = word_hashes(words)
    runs = run_hashes(hashes, width)
    sets = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= width:
            sets.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            sets.append(run_hashes(hashes[a:b], b - a, seed=100 + b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def least_overlap(n, percent: int):
    """Shingles that a set of n must share with any set that it is similar to."""
    return (percent * n + 99) // 100


def must_share(percent: int, n: Column, m: Column) -> Column:
    """Shingles that sets of n and m must share to be similar."""
    return F.floor((percent * (n + m) + 99 + percent) / (100 + percent))


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    return tuple(int(mixed(s ^ np.uint64(seed)).sum(dtype=np.uint64).view(np.int64)) for seed in (0, 0x5851F42D4C957F2D))


def tight(tokens: np.ndarray) -> bytes:
    """Sorted sets one after another: steps of the highest bytes, which are small in a sorted set, are compressed."""
    parts = np.ascontiguousarray(tokens, "<u8").view(np.uint8).reshape(-1, 8)
    return parts[:, :7].tobytes() + zlib.compress(np.diff(parts[:, 7], prepend=np.uint8(0)).tobytes(), 1)


def loose(blob: memoryview, n: int) -> np.ndarray:
    parts = np.empty((n, 8), np.uint8)
    parts[:, :7] = np.frombuffer(blob, np.uint8, 7 * n).reshape(n, 7)
    parts[:, 7] = np.cumsum(np.frombuffer(zlib.decompress(blob[7 * n :]), np.uint8), dtype=np.uint8)
    return parts.view("<u8").ravel()


def chunked_sets(docs: DataFrame, width: int) -> DataFrame:
    """Rows of two kinds from one reading: ``id, n, key, key2`` of each document, and chunks of documents.

    A chunk has ``ids``, ``sizes`` and ``tokens`` of its sets, without null ids, empty sets and sets that it has already.
    """
    names = ["id", "n", "key", "key2", "chunk", "ids", "sizes", "tokens"]
    kinds = [pa.int64()] * 5 + [pa.binary()] * 3

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch, "text", CHUNK_BYTES):
                docs, sets = chunk.column(0).to_pylist(), shingle_sets(chunk.column(1), width)
                keys = [set_keys(s) for s in sets]
                held: dict[tuple[int, int], int] = {}
                for k, (doc, s, key) in enumerate(zip(docs, sets, keys)):
                    if doc is not None and len(s):
                        held.setdefault(key, k)
                own = list(held.values())
                blobs = [np.array([docs[k] for k in own], np.int64).tobytes(), np.array([len(sets[k]) for k in own], np.int64).tobytes()]
                blobs.append(tight(np.concatenate([np.zeros(0, np.uint64), *(sets[k] for k in own)])))
                columns = [docs, [len(s) for s in sets], [k[0] for k in keys], [k[1] for k in keys]]
                none = [None] * len(docs)
                last = [None] * 4 + [chunk_number, *blobs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*(columns[k] if k < 4 else none), last[k]], kind) for k, kind in enumerate(kinds)], names
                )
                chunk_number += 1

    return docs.mapInArrow(rows, "id long, n long, key long, key2 long, chunk long, ids binary, sizes binary, tokens binary")


def levels(sets: DataFrame, total: int) -> DataFrame:
    """``chunk, bucket, levels``: for each different shingle of a chunk, in order, a byte that grows with its count.

    ALONE is for one document, and eight steps for each doubling above. A bucket has about BUCKET shingles and is
    a range of hashes; a shingle comes once from each chunk, with its number of documents there.
    """
    bits = max(1, math.ceil(math.log2(max(2, total / BUCKET))))
    shift = np.uint64(64 - bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sizes, blob in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                n = int(np.frombuffer(sizes.as_buffer(), np.int64).sum())
                tokens, counts = np.unique(loose(memoryview(blob.as_buffer()), n), return_counts=True)
                buckets, starts = np.unique(tokens >> shift, return_index=True)
                ends = np.append(starts[1:], len(tokens))
                parts = [(tight(tokens[a:b]), zlib.compress(counts[a:b].astype(np.uint32).tobytes(), 1)) for a, b in zip(starts, ends)]
                columns = [pa.array(buckets.astype(np.int64)), pa.array([chunk] * len(parts), pa.int64())]
                columns += [pa.array([part[k] for part in parts], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "tokens", "counts"])

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = [np.frombuffer(zlib.decompress(x), np.uint32) for x in rows.counts]
        tokens = [loose(memoryview(x), len(c)) for x, c in zip(rows.tokens, counts)]
        found, place = np.unique(np.concatenate(tokens), return_inverse=True)
        count = np.bincount(place, np.concatenate(counts), len(found))
        level = np.minimum(255, 8 * np.log2(count)).astype(np.uint8)[place]
        ends = np.cumsum([len(t) for t in tokens])
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(level, ends[:-1])]
        return pd.DataFrame({"chunk": rows.chunk, "bucket": key[0], "levels": parts})

    asked = sets.select("chunk", "sizes", "tokens").mapInArrow(ask, "bucket long, chunk long, tokens binary, counts binary")
    return asked.groupBy("bucket").applyInPandas(answer, "chunk long, bucket long, levels binary")


def prefixes(sets: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """``token, key, id, n, own, place`` of the longest prefix of each set, for the shingles that others hold too.

    ``own`` counts the shingles of the whole set that no other document has; they are the first in order, so that
    many sets have nothing else in their prefix.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, blob, told in zip(*(batch.column(k) for k in range(4))):
                ends = np.cumsum(np.frombuffer(sizes.as_buffer(), np.int64))
                tokens = loose(memoryview(blob.as_buffer()), int(ends[-1]) if len(ends) else 0)
                known = sorted(told.as_py(), key=lambda x: x["bucket"])
                level = np.frombuffer(b"".join(zlib.decompress(x["levels"]) for x in known), np.uint8)
                level = level[np.unique(tokens, return_inverse=True)[1]]
                out: list[list] = [[np.zeros(0, np.int64)] for _ in range(6)]
                for doc, a, b in zip(np.frombuffer(ids.as_buffer(), np.int64), np.append(0, ends[:-1]), ends):
                    s, steps, n = tokens[a:b], level[a:b], int(b - a)
                    size = min(n, n - least_overlap(n, percent) + MATCHES)
                    own = int((steps == ALONE).sum())
                    if own >= size:
                        continue
                    order = np.argsort((steps.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")[own:size]
                    same = len(order)
                    for column, values in zip(out, (s[order].view(np.int64), *(np.full(same, x) for x in (set_keys(s)[0], doc, n, own)), np.arange(own + 1, size + 1))):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], ["token", "key", "id", "n", "own", "place"])

    told = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "levels")).alias("told"))
    joined = sets.join(told, "chunk").select("ids", "sizes", "tokens", "told")
    return joined.mapInArrow(cut, "token long, key long, id long, n long, own long, place long")


def possible(percent: int, over: str = "y") -> Column:
    """Whether two sets can be similar, by their sizes and the shingles that only one of them has."""
    n, m = F.col("n"), F.col(f"n_{over}")
    shared = F.least(n - F.col("own"), m - F.col(f"own_{over}"))
    return 100 * shared >= percent * (n + m - shared)


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, shelf: Shelf) -> DataFrame:
    """The pairs ``x`` - ``y`` whose whole sets are similar. Only the texts of documents in a pair are read."""
    needed = pairs.select(F.col("x").alias("id")).union(pairs.select(F.col("y").alias("id"))).distinct()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(chunk.column(1), width)]
                yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(sets, pa.binary())], ["id", "hashes"])

    sets = docs.join(needed, "id", "left_semi").mapInArrow(hashed, "id long, hashes binary")
    sets = shelf.put(sets.filter(F.length("hashes") > 0), "sets")
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("hashes").alias("hx")), "x").join(
        sets.select(F.col("id").alias("y"), F.col("hashes").alias("hy")), "y"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for hx, hy in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(hx.as_buffer(), np.uint64), np.frombuffer(hy.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            batch = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])

    links = shelf.put(both.select("x", "y", "hx", "hy").mapInArrow(compare, "a long, b long").distinct(), "links")
    shelf.drop("sets")
    return links


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links) of every row.

    Two rows link when 100 * intersection >= ``percent`` * union of their shingle sets. A null or empty text has
    no shingles and no links. Rows that share an id are one document with several sets; a null id has a null
    component and takes no part. Texts are compared whole, in any number; copies of a set count once.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "ngrams")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with rows_per_batch(spark, TEXTS):
        found = shelf.put(chunked_sets(rows, width), "chunks")
    own = shelf.put(found.filter("chunk is null").select("id", "n", "key", "key2"), "own")
    same = own.filter("n > 0 and id is not null").groupBy("key", "key2", "n").agg(F.min("id").alias("class"))
    sets = found.filter("chunk is not null").select("chunk", "ids", "sizes", "tokens")
    with rows_per_batch(spark, CHUNKS):
        answers = shelf.put(levels(sets, own.agg(F.sum("n")).first()[0] or 0), "levels")
        raw = shelf.put(prefixes(sets, answers, percent), "prefixes")
    shelf.drop("chunks", "levels")
    # copies of a set in several chunks count once
    postings = raw.groupBy("token", "key", "n").agg(F.min("id").alias("id"), F.min("own").alias("own"), F.min("place").alias("place"))
    postings = shelf.put(postings, "postings")
    shelf.drop("prefixes")
    met = postings.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    postings = shelf.put(postings.join(met, "token"), "shared")
    overlap = F.expr(f"({percent} * n + 99) div 100")
    first = F.col("n") - overlap + 1
    # candidates of m shared shingles are estimated by the m-th longest of the set's lists, as if each held the next
    sorted_lists = F.sort_array(F.collect_list("f"), asc=False)
    best, lowest = F.lit(1), F.lit(None).cast("double")
    for m in range(1, MATCHES + 1):
        within = F.col("place") <= F.col("n") - F.expr(f"(2 * {percent} * n + 99 + {percent}) div (100 + {percent})") + m
        scan = F.sum(F.when(within, F.col("f") - 1).otherwise(0))
        cost = scan + VERIFY_COST * (F.coalesce(F.get(sorted_lists, F.lit(m - 1)), F.lit(1)) - 1.0)
        best, lowest = F.when(lowest.isNull() | (cost < lowest), m).otherwise(best), F.least(cost, lowest)
    # a set with no shared shingle in its prefix is in no list
    choice = postings.groupBy("key", "n").agg(best.alias("wish"))
    asks = F.least(F.col("wish").cast("long"), overlap).alias("asks")
    lists = postings.join(choice, ["key", "n"]).select("token", "id", "n", "own", "place", asks, first.alias("first"))
    lists = shelf.put(lists.filter(F.col("place") < F.col("first") + F.col("asks")), "lists")
    shelf.drop("postings", "shared")

    # first against one set of each list
    centre = F.min(F.struct(F.col("own"), F.col("id"))).alias("c")
    held = lists.groupBy("token").agg(centre, F.count(F.lit(1)).alias("size")).filter("size > 1").select("token", F.col("c.id").alias("id"))
    middle = lists.join(held, ["token", "id"]).select("token", *[F.col(c).alias(f"{c}_y") for c in ("id", "n", "own", "place", "asks", "first")])
    tried = shelf.put(matched(lists.join(middle, "token").filter(F.col("id") != F.col("id_y")), percent), "tried")
    near = verified(tried, rows, width, percent, shelf)
    reached = shelf.put(components(near, shelf), "reached")

    # then all pairs of sets that share a list and are in different components
    marked = lists.join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    marked = shelf.put(marked, "marked")
    shelf.drop("reached")
    # how much a component's sets can share, how small they are and how early they have the shingle rules out most
    # other components in its lists, and then most of its own sets
    groups = marked.groupBy("token", "component").agg(
        F.max(F.col("n") - F.col("own")).alias("most"),
        F.min("n").alias("least"),
        F.min(F.col("place") - F.col("n")).alias("early"),
        F.max("asks").alias("wants"),
        F.count(F.lit(1)).alias("held"),
    )
    beside = groups.select("token", *[F.col(c).alias(f"{c}_y") for c in ("component", "most", "least", "early", "wants", "held")])
    shared, wants = must_share(percent, F.col("least"), F.col("least_y")), F.least("wants", "wants_y")
    near_enough = (F.least("most", "most_y") >= shared) & (F.greatest("early", "early_y") + shared <= wants)
    # the component with fewer sets in the list is the first to be listed
    fewer = F.struct("held", "component") < F.struct("held_y", "component_y")
    apart = groups.join(beside, "token").filter(fewer & near_enough)
    apart = apart.select("token", "component", "component_y", "least_y", "wants_y")
    in_time = F.col("place") - F.col("n") + must_share(percent, F.col("n"), F.col("least_y")) <= F.least("asks", "wants_y")
    others = marked.select("token", *[F.col(c).alias(f"{c}_y") for c in ("component", "id", "n", "own", "place", "asks", "first")])
    rest = apart.join(marked, ["token", "component"]).filter(in_time).join(others, ["token", "component_y"])
    pairs = matched(rest, percent).join(tried, ["x", "y"], "left_anti")
    pairs = shelf.put(pairs, "pairs")
    shelf.drop("tried", "marked")
    far = verified(pairs, rows, width, percent, shelf)
    # the id that stands for a set in the lists need not be the smallest of its copies
    stand_ins = lists.select("id").distinct().join(own, "id").join(same, ["key", "key2", "n"]).select(F.col("id").alias("a"), F.col("class").alias("b"))
    final = components(near.union(far).union(same_ids(own, same)).union(stand_ins), shelf)
    # the result reads sizes, classes and components only, and may be read long after
    shelf.drop("lists", "pairs", "links")
    result = (
        own.join(same, ["key", "key2", "n"], "left")
        .join(final.select(F.col("id").alias("class"), F.col("component").alias("component_id")), "class", "left")
        .select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "class", "id")).alias("component_id"))
    )
    return result


def same_ids(own: DataFrame, same: DataFrame) -> DataFrame:
    """Links between the classes of the rows that share an id."""
    rows = own.filter("id is not null and n > 0").join(same, ["key", "key2", "n"]).select("id", "class").distinct()
    return rows.select(F.col("id").alias("a"), F.col("class").alias("b")).filter("a != b").join(
        rows.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("id").alias("a")), "a", "left_semi"
    )


def matched(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``x`` < ``y`` with as many shared shingles in their prefixes as the less demanding asks for."""
    least = F.least("asks", "asks_y")
    # what this pair must share leaves a shorter prefix of each than the least that any pair must
    shared = must_share(percent, F.col("n"), F.col("n_y"))
    within = (F.col("place") <= F.col("n") - shared + least) & (F.col("place_y") <= F.col("n_y") - shared + least)
    return (
        rows.filter(possible(percent) & within)
        .select(F.least("id", "id_y").alias("x"), F.greatest("id", "id_y").alias("y"), least.alias("least"), "token")
        .groupBy("x", "y")
        .agg(F.countDistinct("token").alias("shared"), F.min("least").alias("least"))
        .filter("shared >= least")
        .select("x", "y")
    )
