"""Near-duplicate vectors with equal labels: subspace pigeonhole join.

Unit vectors are rotated and split into blocks of 8 numbers. Vectors with cosine c are 2 - 2c apart (squared), so
a pair over the threshold is in at least one block as near as that block's share of the whole budget. Each block
is range-joined on a grid of cells as wide as the range; candidates of all blocks are verified with the cosine in
double precision. A pair is judged in the first block that brings it together, so links are counted where they
are found and no list of pairs is ever kept; a task passes on each vector's number of links and a spanning forest.
Equal vectors of a label are one vector with a weight, so that a group of copies costs no more than one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.llm.links import components
from lapledger.llm.tables import Shelf

BLOCK = 8
#: Numbers of a block that make the grid; the next one orders a cell's vectors.
GRID = 3
#: A cell is dealt to as many tasks as it holds this many vectors.
CELL_ROWS = 1_000
TILE = 256
SPAN = 1 << 20


def rotation(n: int) -> np.ndarray:
    """The same orthogonal matrix each time for a number of dimensions."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(n)).normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def blocks_of(n: int) -> list[slice]:
    edges = np.linspace(0, n, max(1, n // BLOCK) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def rows_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each number of dimensions: places in the column and vectors, of those that can link with any."""
    sizes = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        own = values[starts[at][:, None] + np.arange(n)]
        with np.errstate(invalid="ignore", over="ignore"):
            norm = np.sqrt((own * own).sum(1))
            good = np.isfinite(own).all(1) & (norm > 0) & np.isfinite(norm)
        if good.any():
            yield at[good], own[good]


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in single precision. Each row's numbers depend on that row only, to the last bit."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    turn = rotation(vectors.shape[1])
    out = np.empty(unit.shape, np.float32)
    for j in range(out.shape[1]):
        out[:, j] = (unit * turn[j]).sum(1)
    return out


def ranges(n: int, threshold: float) -> list[float]:
    """Each block's range: its share of the squared distance, and a margin for rounding."""
    return [float(np.sqrt((2 - 2 * threshold) * (b.stop - b.start) / n * (1 + 1e-4))) + 1e-6 for b in blocks_of(n)]


def cells(rows: DataFrame, threshold: float) -> DataFrame:
    """``id, label, mark, dims, block, cell, home``: where each vector lives, and the later cells within its range."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in rows_of(batch.column(2)):
                n = vectors.shape[1]
                y = turned(vectors).astype(np.float64)
                for b, (part, r) in enumerate(zip(blocks_of(n), ranges(n, threshold))):
                    grid = y[:, part][:, :GRID]
                    code = lambda q: sum((q[:, i].astype(np.int64) + SPAN // 2) * SPAN ** (2 - i) for i in range(q.shape[1]))
                    home, low, high = (np.floor((grid + d) / (2 * r)) for d in (0, -r, r))
                    own = code(home)
                    found = [(np.arange(len(at)), own, np.ones(len(at), bool))]
                    for corner in range(1 << grid.shape[1]):
                        side = np.array([corner >> i & 1 for i in range(grid.shape[1])], bool)
                        fresh = ((low != high) | ~side).all(1)
                        other = code(np.where(side, high, low))
                        take = np.flatnonzero(fresh & (other > own))
                        found.append((take, other[take], np.zeros(len(take), bool)))
                    which, cell, lives = (np.concatenate(x) for x in zip(*found))
                    index = pa.array(at[which])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(k).take(index) for k in (0, 1, 3)), pa.array(np.full(len(which), n, np.int32)),
                            pa.array(np.full(len(which), b, np.int32)), pa.array(cell), pa.array(lives),
                        ],
                        ["id", "label", "mark", "dims", "block", "cell", "home"],
                    )

    rows = rows.select("id", "label", "embedding", "mark")
    return rows.mapInArrow(place, "id long, label string, mark long, dims int, block int, cell long, home boolean")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of n by the links a - b."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


class Side:
    """Vectors of a cell, in the order of the number that follows the grid."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int, weights: np.ndarray | None = None, times: np.ndarray | None = None):
        y = turned(vectors)
        own = y[:, blocks_of(vectors.shape[1])[block]].astype(np.float64)
        key = own[:, min(GRID, own.shape[1] - 1)]
        order = np.argsort(key, kind="stable")
        self.ids, self.key, self.own, self.y = ids[order], key[order], own[order], y[order].astype(np.float64)
        self.unit = (vectors / np.sqrt((vectors * vectors).sum(1))[:, None])[order]
        self.squares = (self.own * self.own).sum(1)
        one = np.ones(len(ids), np.int64)
        self.weights, self.times = ((one if x is None else x)[order] for x in (weights, times))


def links_between(p: Side, h: Side, block: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in p and h of the pairs that this block is the first to bring together and that are similar."""
    dims = h.unit.shape[1]
    parts, limits = blocks_of(dims), np.array([r * r for r in ranges(dims, threshold)])
    r = float(np.sqrt(limits[block]))
    for start in range(0, len(p.ids), TILE):
        tile = slice(start, start + TILE)
        lo = int(np.searchsorted(h.key, p.key[tile][0] - r, side="left"))
        hi = int(np.searchsorted(h.key, p.key[tile][-1] + r, side="right"))
        for first in range(lo, hi, 4 * TILE):
            other = slice(first, min(hi, first + 4 * TILE))
            apart = p.squares[tile][:, None] + h.squares[other] - 2 * p.own[tile] @ h.own[other].T
            a, b = np.nonzero(apart <= limits[block] * (1 + 1e-6) + 1e-9)
            a, b = a + start, b + first
            keep = (a < b) & (p.ids[a] != h.ids[b]) if p is h else p.ids[a] != h.ids[b]
            a, b = a[keep], b[keep]
            apart = (p.y[a] - h.y[b]) ** 2
            near = np.stack([apart[:, part].sum(1) for part in parts]) <= limits[:, None]
            keep = near[block] & ~near[:block].any(0)
            a, b = a[keep], b[keep]
            keep = (p.unit[a] * h.unit[b]).sum(1) >= threshold
            if keep.any():
                yield a[keep], b[keep]


def found_between(p: Side, h: Side, block: int, threshold: float) -> pa.RecordBatch | None:
    """``id, links, least`` of what is linked here."""
    shift = 0 if p is h else len(h.ids)
    ids = h.ids if p is h else np.concatenate([h.ids, p.ids])
    counts, low = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for a, b in links_between(p, h, block, threshold):
        np.add.at(counts, a + shift, p.times[a] * h.weights[b])
        np.add.at(counts, b, h.times[b] * p.weights[a])
        tree = np.flatnonzero(low != np.arange(len(ids)))
        low = forest(len(ids), np.concatenate([a + shift, tree]), np.concatenate([b, low[tree]]))
    some = np.flatnonzero(counts)
    if not len(some):
        return None
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(counts[some]), pa.array(ids[low[some]])], ["id", "links", "least"])


def judge(rows: DataFrame, threshold: float) -> DataFrame:
    """``id, links, least`` for the vectors of each cell that have links there.

    Of a cell's chunk a task holds the residents; visitors pass by in batches, whatever their number.
    """

    def side(batches: list[pa.RecordBatch], key: tuple) -> Side:
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = table["embedding"].combine_chunks().flatten().cast(pa.float64()).to_numpy().reshape(-1, key[1])
        return Side(table["id"].to_numpy(), vectors, key[2], table["weight"].to_numpy(), table["times"].to_numpy())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, residents = None, [], None

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal residents
            if waiting:
                residents = side(waiting, key)
                waiting.clear()
                if (out := found_between(residents, residents, key[2], threshold)) is not None:
                    yield out

        for batch in batches:
            marks = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dims", "block", "cell", "chunk", "home"))))
            edges = [i for i in range(len(marks)) if not i or marks[i] != marks[i - 1]]
            for a, b in zip(edges, [*edges[1:], len(marks)]):
                *own, home = marks[a]
                if key != own:
                    yield from settle()
                    key, residents = own, None
                if home:
                    waiting.append(batch.slice(a, b - a))
                    continue
                yield from settle()
                if residents is not None:
                    out = found_between(side([batch.slice(a, b - a)], key), residents, key[2], threshold)
                    if out is not None:
                        yield out
        yield from settle()

    keys = ["label", "dims", "block", "cell", "chunk"]
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, F.desc("home"))
    return ordered.mapInArrow(compare, "id long, links long, least long")


def nodes_of(able: DataFrame) -> DataFrame:
    """``label, mark, mark2, twin, id, weight, times``: equal vectors of a label as one, under their smallest id.

    ``mark`` and ``mark2`` are hashes of the vector. Rows whose id occurs again are nodes of their own (``twin`` is
    the id), as they link with no row of that id; the same row ``times`` over is one of them.
    """
    twins = able.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.col("id").alias("twin"))
    grouped = able.join(twins, "id", "left").groupBy("label", "mark", "mark2", "twin")
    nodes = grouped.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    return nodes.withColumn("times", F.when(F.col("twin").isNull(), 1).otherwise(F.col("weight")))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row.

    Rows link when their labels are equal and not null and the cosine of their vectors is ``threshold`` or more.
    Vectors that are null, empty, zero or hold a null or non-finite number link with nothing, nor do vectors of
    different lengths. Rows that share an id get the links of all of them; a null id has null results and takes
    no part. A crowded cell is dealt in chunks to many tasks, each pair of chunks once.
    """
    shelf = Shelf(vectors.sparkSession, "vectors")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<float>").alias("embedding")
    )
    # a number that is null, infinite or no number is not below infinity
    able = rows.filter(
        "id is not null and label is not null and forall(embedding, x -> coalesce(abs(x) < float('inf'), false)) and exists(embedding, x -> x != 0)"
    )
    able = able.withColumns({"mark": F.xxhash64("embedding"), "mark2": F.xxhash64(F.lit(1), F.col("embedding"))})
    named = shelf.put(able.select("id", "label", "mark", "mark2"), "named")
    nodes = shelf.put(nodes_of(named), "nodes")
    one = able.join(nodes.select("id", "label", "mark", "mark2", "weight", "times"), ["id", "label", "mark", "mark2"])
    one = shelf.put(one.dropDuplicates(["id", "label", "mark", "mark2"]).drop("mark2"), "vectors")
    where = shelf.put(cells(one, threshold), "cells")
    keys = ["label", "dims", "block", "cell"]
    crowd = where.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("homes")).filter("homes > 0 and rows > 1")
    sized = where.join(crowd, keys).withColumn("chunks", F.ceil(F.col("rows") / CELL_ROWS))
    own = F.pmod(F.xxhash64("id"), F.col("chunks"))
    # residents live in one chunk and visit the later ones; visitors go to all
    dealt = sized.withColumn("own", own).withColumn(
        "chunk", F.explode(F.expr("sequence(if(home, own, 0L), chunks - 1)"))
    )
    dealt = dealt.select("id", "mark", *keys, "chunk", (F.col("home") & (F.col("chunk") == F.col("own"))).alias("home"))
    found = shelf.put(judge(dealt.join(one, ["id", "label", "mark"]), threshold), "found")
    shelf.drop("cells", "vectors")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), shelf)
    told = nodes.join(counts, "id", "left").join(joined, "id", "left").select(
        "label", "mark", "mark2", "twin", "id", (F.col("weight") - F.col("times")).alias("copies"), "links", F.coalesce("component", "id").alias("component")
    )
    # a twin is told by its id, every other vector by its label and marks
    alone = named.join(told.filter("twin is null").drop("id", "twin"), ["label", "mark", "mark2"]).join(
        told.filter("twin is not null").select("id"), "id", "left_anti"
    )
    alone = alone.select("id", (F.coalesce("links", F.lit(0)) + F.col("copies")).alias("n_links"), "component")
    twins = told.filter("twin is not null").select("id", F.coalesce("links", F.lit(0)).alias("n_links"), "component").distinct()
    known = F.col("id").isNotNull()
    return (
        rows.select("id")
        .join(alone.union(twins), "id", "left")
        .select(
            "id",
            F.when(known, F.coalesce("n_links", F.lit(0))).alias("n_links"),
            F.when(known, F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn("kept", F.col("id") == F.col("component_id"))
    )
