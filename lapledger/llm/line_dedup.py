"""Removal of repeated and nearly repeated lines: segment-partition edit join, in DataFrame operations only.

A line within ``edits`` edits of another contains one of the other's ``edits + 1`` equal segments unchanged. Each
line is indexed under its length and its segments, and probes the index with those of its substrings that a
segment of a line of such a length can lie at, given that the edits before and after it share the limit. What
meets there is verified with a banded bit-parallel edit distance. Equal lines are one class and join once.

Lines that share a key first meet one line of it; only pairs of lines that are in different components by then
are listed. A large group of lines that are nearly equal so costs as many pairs as it has lines.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.llm.links import components
from lapledger.llm.tables import Shelf

EDITS = 2
MIN_CHARS = 20
#: Bits of the table that is sent to all tasks before texts are fetched: 2**16 rows of 64 bits, whatever the input.
SENT_BITS = 22
#: Pairs that a task verifies.
TASK_PAIRS = 4_000


def lines_of(rows: DataFrame) -> DataFrame:
    """``id, place, line`` of every line."""
    return rows.select("id", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))


def named(lines: DataFrame) -> DataFrame:
    """With ``h``, a line's name in joins, and ``g``, a second hash; both together stand for its text."""
    return lines.withColumn("h", F.xxhash64("line")).withColumn("g", F.xxhash64(F.lit(1), F.col("line")))


def spots(edits: int) -> list[tuple[int, int, int]]:
    """(shorter by, segment, shift) of the substrings to probe, the indexed segments themselves first."""
    found = [
        (less, i, d)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for d in range(-i, i + 1)
        if abs(d - less) <= edits - i
    ]
    return sorted(found, key=lambda x: (x[0] != 0 or x[2] != 0, x))


def parities(line: Column) -> tuple[Column, Column]:
    """Bits of a line's words and of its pairs of characters: each is set if its hash occurs an odd number of times.

    Each edit changes three words at most, and four pairs: lines within the edits differ in few bits.
    """
    bit = lambda h, bits: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(bits)).cast("int"))
    none = F.lit(0).cast("long")
    words = F.aggregate(F.split(line, " "), none, lambda x, w: x.bitwiseXOR(bit(F.xxhash64(w), 31)))
    follow = lambda a: F.aggregate(
        F.sequence(F.lit(1), F.size(a) - 1), none, lambda x, i: x.bitwiseXOR(bit(F.xxhash64(F.get(a, i - 1), F.get(a, i)), 64))
    )
    return words.alias("parity"), let(F.split(line, ""), follow).alias("pairs")


def keys(distinct: DataFrame, edits: int) -> DataFrame:
    """``key, h, n, indexed``: a row for each indexed segment and each probe of each line."""
    parts = edits + 1
    every = F.array(*[F.struct(F.lit(x).alias("less"), F.lit(i).alias("i"), F.lit(d).alias("d")) for x, i, d in spots(edits)])
    # a row for each spot and then one short expression: one long expression for all is code that is never compiled
    rows = distinct.select("h", "n", "line", F.explode(every).alias("spot"))
    i, length = F.col("spot.i"), F.col("n") - F.col("spot.less")
    rows = rows.withColumns({"length": length, "size": F.floor(length / parts).cast("int")})
    longer = F.col("length") - F.col("size") * parts  # so many of the last segments have one more
    start = F.col("size") * i + F.greatest(F.lit(0), longer - (parts - i)) + F.col("spot.d")
    width = F.col("size") + F.when(longer > parts - 1 - i, 1).otherwise(0)
    rows = rows.withColumns({"start": start, "width": width})
    inside = (F.col("start") >= 0) & (F.col("start") + F.col("width") <= F.col("n")) & (F.col("width") > 0)
    key = F.xxhash64(i, F.col("length"), F.substr("line", F.col("start") + 1, F.col("width")))
    indexed = (F.col("spot.less") == 0) & (F.col("spot.d") == 0)
    return rows.filter(inside).select(key.alias("key"), "h", "n", indexed.alias("indexed"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def distance(most: int, a: Column, b: Column) -> Column:
    """The edit distance of two texts, given as arrays of characters, if it is ``most`` or less.

    Else ``most`` + 1. Banded and bit-parallel: a bit for each cell of the band around the diagonal tells whether
    the distance grows (``vp``) or falls (``vn``) from the cell before it; a step along ``b`` renews them all at
    once. The band's lowest diagonal carries the distance ``d``, from where ``a`` ends the last row does. Needs
    more than ``most`` characters in ``a`` and lengths that differ by ``most`` at most.
    """
    top = 2 * most + 1  # the bit of the lowest diagonal: place i + most of a
    every = (1 << (top + 1)) - 1
    down, gap = F.size(a) - most, F.abs(F.size(a) - F.size(b))
    other = lambda v: F.lit(every) - v
    either, both = Column.bitwiseOR, Column.bitwiseAND
    at = lambda v, place: F.call_function("shiftrightunsigned", v, place).bitwiseAND(F.lit(1))
    pack = lambda vp, vn, d: F.struct(vp.alias("vp"), vn.alias("vn"), d.alias("d"))

    def step(state: Column, i: Column) -> Column:
        vp, vn = state["vp"], state["vn"]
        same = lambda c: sum(
            (F.when(F.get(a, i + k) == c, 1 << (top - most + k)).otherwise(0) for k in range(-most, most + 1)), F.lit(0)
        )
        diagonal = lambda m: either(either(both(both(m, vp) + vp, F.lit(every)).bitwiseXOR(vp), m), vn)

        def renewed(d0: Column) -> Column:
            hp, hn, moved = either(vn, other(either(d0, vp))), both(d0, vp), F.shiftrightunsigned(d0, 1)
            row = F.lit(top - 1) - (i - down)
            change = F.when(i < down, F.lit(1) - F.shiftrightunsigned(d0, top)).otherwise(at(hp, row) - at(hn, row))
            return pack(either(hn, other(either(moved, hp))), both(moved, hp), state["d"] + change)

        return let(let(F.get(b, i), same), lambda m: let(diagonal(m), renewed))

    start = pack(F.lit((((1 << (most + 1)) - 1) << (top - most)) & every), F.lit(0), F.lit(most))
    far = lambda s: s["d"] > F.lit(2 * most) + gap
    run = F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), start, lambda s, i: F.when(far(s), s).otherwise(step(s, i)), lambda s: s["d"])
    return F.least(run, F.lit(most + 1))


def close(pairs: DataFrame, most: int) -> DataFrame:
    """The rows whose texts ``x`` and ``y`` are within ``most`` edits."""
    rows = pairs.filter(F.abs(F.length("x") - F.length("y")) <= most).filter(F.length("x") > most)
    # bound once in one expression: Spark moves filters below projections and would split both texts for each character
    letters = F.struct(F.split("x", "").alias("a"), F.split("y", "").alias("b"))
    return rows.filter(let(letters, lambda s: distance(most, s["a"], s["b"])) <= most)


def sent(values: DataFrame, name: str) -> DataFrame:
    """A bit table of fixed size over the values of a long column, for :func:`held`."""
    slot = F.pmod(F.col(name), F.lit(1 << SENT_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    return values.groupBy(F.floor(slot / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))


def held(rows: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The rows whose value is among the distinct ``values``. The bit table keeps most others out of the shuffle."""
    slot = F.pmod(F.col(name), F.lit(1 << SENT_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    found = rows.withColumn("word", F.floor(slot / 64)).join(F.broadcast(sent(values, name)), "word")
    # values are distinct; a semi join would be moved below the broadcast one, and all rows be shuffled
    return found.filter(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits").join(values.select(name), name)


def alike(edits: int) -> Column:
    """Whether lines of a key can be within the edits: by length, then by their parities."""
    differ = lambda c: F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_y")))
    least = (differ("parity") <= 3 * edits) & (differ("pairs") <= 4 * edits)
    return (F.col("n") >= F.col("n_y")) & (F.col("n") - F.col("n_y") <= edits) & least


def ordered() -> tuple[Column, Column]:
    return F.least("h", "h_y").alias("x"), F.greatest("h", "h_y").alias("y")


def verified(pairs: DataFrame, distinct: DataFrame, edits: int, shelf: Shelf) -> DataFrame:
    """The links ``a`` - ``b`` among the pairs ``x`` - ``y`` of names."""
    names = shelf.put(pairs.select(F.col("x").alias("h")).union(pairs.select(F.col("y").alias("h"))).distinct(), "names")
    texts = shelf.put(held(distinct.select("h", "line"), names, "h"), "texts")
    both = pairs.join(texts.select(F.col("h").alias("x"), F.col("line").alias("tx")), "x").join(
        texts.select(F.col("h").alias("y"), F.col("line").alias("ty")), "y"
    )
    both = both.select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("tx").alias("x"), F.col("ty").alias("y"))
    # few bytes, much work: by number of pairs, not by size
    tasks = max(1, math.ceil(pairs.count() / TASK_PAIRS))
    # an aggregate, so that Spark does not verify before it deals the pairs out
    both = both.repartition(tasks, "a", "b").groupBy("a", "b").agg(F.first("x").alias("x"), F.first("y").alias("y"))
    near = shelf.put(close(both, edits).select("a", "b"), "near")
    shelf.drop("names", "texts")
    return near


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, n_lines, removed`` (places of the lines to remove, from 0, in order) of every row.

    Lines of ``min_chars`` characters or more are linked when they are within ``edits`` edits; of all lines that
    are reachable from one another the first stays (smallest id, then place). Shorter lines always stay. A null
    text has no lines, an empty one has one. Rows that share an id share their places: what is first or removed
    in one of them is so in all. A null id takes no part and loses nothing.
    """
    if min_chars <= edits * (edits + 1):
        raise ValueError("lines of so few characters have empty segments")
    shelf = Shelf(docs.sparkSession, "lines")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = named(lines_of(rows.filter("id is not null")).filter(F.length("line") >= min_chars))
    placed = shelf.put(lines.select("h", "g", "id", "place"), "placed")
    classes = placed.groupBy("h", "g").agg(F.min(F.struct("id", "place")).alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = shelf.put(classes.select("h", "g", "first.id", "first.place", "copies"), "classes")

    distinct = lines.join(classes.select("h", "g", "id", "place"), ["h", "g", "id", "place"])
    distinct = shelf.put(distinct.select("h", F.length("line").alias("n"), "line"), "distinct")
    # a key joins lines only where one of them has it as a segment of its own: first the keys, then the lines of those
    every = shelf.put(keys(distinct, edits), "every")
    useful = every.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("indexed").alias("indexed"))
    useful = shelf.put(useful.filter("rows > 1 and indexed").select("key"), "useful")
    every = shelf.put(held(every, useful, "key"), "keys")
    shelf.drop("every", "useful")
    names = shelf.put(every.select("h").distinct(), "names")
    marks = shelf.put(held(distinct.select("h", "line"), names, "h").select("h", *parities(F.col("line"))).distinct(), "marks")
    every = shelf.put(every.join(marks, "h"), "marked-keys")
    # the line with the least name among those with the segment stands for all of a key
    line = ("h", "n", "parity", "pairs")
    centre = every.filter("indexed").groupBy("key").agg(F.min(F.struct(*line)).alias("c"), F.count(F.lit(1)).alias("size"))
    centre = shelf.put(centre.select("key", *[F.col(f"c.{x}").alias(f"{x}_y") for x in line], "size"), "centre")
    met = shelf.put(every.join(centre, "key").filter("size > 1 or h != h_y"), "met")
    shelf.drop("keys", "names", "marks", "marked-keys", "centre")
    tried = shelf.put(met.filter("h != h_y").filter(alike(edits)).select(*ordered()).distinct(), "tried")
    near = verified(tried, distinct, edits, shelf)
    reached = shelf.put(components(near, shelf), "reached")

    # then lines of other components that have the key as a segment of their own
    marked = met.filter("size > 1").join(reached.withColumnRenamed("id", "h"), "h", "left")
    marked = marked.select("key", *line, "indexed", F.coalesce("component", "h").alias("component"))
    marked = shelf.put(marked, "marked")
    shelf.drop("met", "reached")
    several = marked.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    groups = marked.join(several, "key", "left_semi").groupBy("key", "component")
    groups = shelf.put(groups.agg(F.bool_or("indexed").alias("indexed"), (F.min("h") != F.max("h")).alias("large")), "groups")
    index = marked.filter("indexed").select("key", F.col("component").alias("component_y"), *[F.col(x).alias(f"{x}_y") for x in line])
    # lines that are alone in their component meet as lines, so that only those that can be near are listed
    lone = groups.filter("not large").select("key", "component")
    lines_y = index.join(lone.withColumnRenamed("component", "component_y"), ["key", "component_y"])
    near_lone = marked.join(lone, ["key", "component"]).join(lines_y, "key").filter("component != component_y").filter(alike(edits))
    # a component of several lines meets another one once
    sides = groups.select("key", "component", "large")
    apart = sides.join(groups.filter("indexed").select("key", F.col("component").alias("component_y"), F.col("large").alias("large_y")), "key")
    apart = apart.filter("component != component_y and (large or large_y)").select("key", "component", "component_y")
    near_large = marked.join(apart, ["key", "component"]).join(index, ["key", "component_y"]).filter(alike(edits))
    rest = near_lone.select("h", "h_y").union(near_large.select("h", "h_y"))
    pairs = shelf.put(rest.select(*ordered()).distinct().join(tried, ["x", "y"], "left_anti"), "pairs")
    shelf.drop("tried", "marked", "groups")
    far = verified(pairs, distinct, edits, shelf)
    shelf.drop("distinct", "pairs")
    linked = components(near.union(far), shelf)
    # the result reads these places, classes and components only, and may be read long after
    shelf.drop("near")

    grouped = classes.join(linked.withColumnRenamed("id", "h"), "h")
    first = grouped.groupBy("component").agg(F.min(F.struct("id", "place")).alias("first"))
    shared = grouped.join(first, "component").select("h", "g", "first")
    alone = classes.filter("copies > 1").join(shared, ["h", "g"], "left_anti").select("h", "g", F.struct("id", "place").alias("first"))
    gone = placed.join(shared.union(alone), ["h", "g"]).filter("struct(id, place) != first")
    gone = gone.groupBy("id").agg(F.array_sort(F.collect_set("place")).alias("removed"))
    counted = rows.select("id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    counted = counted.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    return counted.join(gone, "id", "left").select("id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without(text: Column, removed: Column) -> Column:
    """The text without the lines at these places (in order). Flags for all lines are made once, gap by gap."""
    gap = lambda p, k: p - F.coalesce(F.get(removed, k - 1), F.lit(-1)) - 1
    flags = F.flatten(F.transform(removed, lambda p, k: F.concat(F.array_repeat(F.lit(True), gap(p, k)), F.array(F.lit(False)))))
    lines = F.split(text, "\n", -1)
    pairs = F.arrays_zip(lines.alias("line"), flags.alias("stays"))
    kept = F.transform(F.filter(pairs, lambda z: F.coalesce(z["stays"], F.lit(True))), lambda z: z["line"])
    return F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(text)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows and columns of ``docs``, their texts without the lines that :func:`removals` names."""
    found = removals(docs, id_col, text_col, **how).filter(F.size("removed") > 0).select(F.col("id").alias("__id"), F.col("removed").alias("__removed"))
    found = found.dropDuplicates(["__id"])
    joined = docs.join(found, docs[id_col].cast("long") == found["__id"], "left")
    cleaned = F.when(F.col("__removed").isNull(), docs[text_col]).otherwise(without(docs[text_col], F.col("__removed")))
    return joined.withColumn("__text", cleaned).select(*[F.col("__text").alias(c) if c == text_col else docs[c] for c in docs.columns])
