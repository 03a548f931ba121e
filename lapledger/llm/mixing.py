"""Mixing sources to target weights by balanced sampling: the cube method.

A source's target over its size is how often each of its documents is taken on average: the whole part for all,
and one more time with the fractional part as probability. The probabilities move through the null space of two
constraints, the source's number of tokens and of documents, until they are 0 or 1: each step moves three
documents so that both totals stay as they are. Blocks of documents are worked off side by side; the few
documents that a block leaves undecided go to the next round. What is left of a source in the end, a dozen
documents or so, lands: of all ways to decide them the one whose tokens, then documents, come nearest to what
their probabilities add up to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.tables import Shelf, chunks
from lapledger.llm.words import words_of

#: Weights of the sources in the order of their names, from the start again where there are more.
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL, MOST = 1.5, 2.0
BLOCK_ROWS = 4_096
NEAR = 1e-9
#: Documents that a block keeps undecided for the next round, and the last block for the landing.
SPARE, LANDING = 6, 12


def sizes(docs: DataFrame) -> DataFrame:
    """``id, source, size`` (words) and ``mark``, a hash of id and text that orders documents at random."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                n = np.diff(words_of(chunk.column(2)).bounds).astype(np.int64)
                yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), pa.array(n), chunk.column(3)], ["id", "source", "size", "mark"])

    rows = docs.withColumn("mark", F.xxhash64("id", "text")).select("id", "source", "text", "mark")
    return rows.mapInArrow(count, "id long, source string, size long, mark long")


def targets_of(size: np.ndarray, weight: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares of ``total`` by weight; what is above ``most`` times a size is shared again among the others."""
    limit, target = most * size.astype(float), np.zeros(len(size))
    free, left = limit > 0, float(total)
    while left > 1e-9 * max(total, 1.0) and free.any():
        target[free] += left * weight[free] / weight[free].sum()
        over = free & (target >= limit)
        left = float((target[over] - limit[over]).sum())
        target[over] = limit[over]
        free &= ~over
    return target


def step(p: np.ndarray, size: np.ndarray, coin: float) -> np.ndarray:
    """Move three probabilities along the direction that keeps tokens and count, until one of them is 0 or 1."""
    u = np.array([size[1] - size[2], size[2] - size[0], size[0] - size[1]], float)
    if not u.any():
        u = np.array([1.0, -1.0, 0.0])
    u = u / np.abs(u).max()
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)).min()
        down = np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf)).min()
    p = p + up * u if coin * (up + down) < down else p - down * u
    return np.where(p < NEAR, 0.0, np.where(p > 1 - NEAR, 1.0, p))


def landed(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few documents, nearest to what their probabilities add up to."""
    ways = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    off, many = np.abs(ways @ size - p @ size), np.abs(ways.sum(1) - p.sum())
    return ways[np.lexsort((many, np.round(off, 6)))[0]].astype(float)


def flown(p: np.ndarray, size: np.ndarray, mark: np.ndarray, last: bool) -> np.ndarray:
    """The probabilities after the steps within a block, in the order of the marks; ``last`` lands what is left."""
    p, size = p.astype(float), size.astype(float)
    order = [int(i) for i in np.lexsort((size, mark)) if 0 < p[i] < 1]
    coins = (mark.astype(np.int64).view(np.uint64) >> np.uint64(11)).astype(float) / 2**53
    spare = LANDING if last else SPARE
    active: list[int] = []
    for i in order[: max(0, len(order) - spare)]:
        active.append(i)
        while len(active) == 3:
            p[active] = step(p[active], size[active], coins[i])
            active = [j for j in active if 0 < p[j] < 1]
    if last:
        left = [*active, *order[max(0, len(order) - spare) :]]
        p[left] = landed(p[left], size[left])
    return p


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
) -> DataFrame:
    """``id, size, source_size, target, copies, taken`` of every row: how often the mix takes each document.

    ``size`` is the number of words (null text: 0). Sources by code point, null last, get ``weights`` in turn and
    share ``total`` times all words, none more than ``most`` times its own. Each row is decided by itself, rows
    that repeat and null ids too; what is random hangs on id and text, so that reruns agree however the rows are
    dealt out. A source without words, and an empty table, has nothing to take.
    """
    shelf = Shelf(docs.sparkSession, "mixing")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source")
    )
    rows = shelf.put(sizes(rows), "sizes")

    def share(_: tuple, sources: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(sources)), key=lambda i: (sources.source.isna().iloc[i], sources.source.iloc[i] or ""))
        sources = sources.iloc[order].reset_index(drop=True)
        weight = np.array([weights[i % len(weights)] for i in range(len(sources))])
        size = sources.source_size.to_numpy(np.float64)
        target = targets_of(size, weight, total * size.sum(), most)
        rate = np.minimum(np.where(size > 0, target / np.maximum(size, 1), 0.0), most)
        whole = np.floor(rate + NEAR)
        part = np.where(rate - whole < NEAR, 0.0, rate - whole)
        sources["number"] = np.arange(len(sources))
        return sources.assign(target=target, whole=whole.astype(np.int64), part=part)

    # one row for each source, whatever the number of documents
    summary = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    plan = summary.groupBy(F.lit(0).alias("all")).applyInPandas(
        share, "source string, source_size long, rows long, number long, target double, whole long, part double"
    )
    plan = shelf.put(plan, "plan")
    units = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "id", "size", "mark", "source_size", "target", "whole", "number", F.col("part").alias("p")
    )

    def fly(block: pd.DataFrame) -> pd.DataFrame:
        last = bool(block.blocks.iloc[0] == 1)
        block["p"] = flown(block.p.to_numpy(), block["size"].to_numpy(), block.mark.to_numpy(), last)
        return block

    done, waiting, turn = units.filter("p <= 0"), units.filter("p > 0"), 0
    while True:
        many = waiting.groupBy("number").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
        blocks = waiting.join(many, "number").withColumn("block", F.pmod(F.xxhash64("mark", F.lit(turn)), "blocks"))
        flew = shelf.put(blocks.repartition("number", "block").groupBy("number", "block").applyInPandas(fly, blocks.schema).select(*units.columns), "round")
        waiting, turn = flew.filter("p > 0 and p < 1"), turn + 1
        done = done.unionByName(flew.filter("p <= 0 or p >= 1"))
        if waiting.isEmpty():
            break
    copies = F.col("whole") + F.when(F.col("p") >= 1, 1).otherwise(0)
    return done.select("id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
