"""Ordered and grouped calculations that hold when one group has a large share of all rows.

A plain window puts each group into one task. That is the best plan while groups are small, and
impossible when a group holds a third of a very large table. Each function here first asks, with one
map-side combined count, whether any group is over the row limit. If some are, only their rows take
another way: Spark deals them out by ranges of the sort key, a window runs in each range, and what the
earlier ranges of a group add up to is joined back. A hash of the whole row is the last sort field, so
that rows with equal sort keys are dealt out too. Both ways give the same rows; only the work is divided
differently.

Ranges are written to the shared folder before they are used, so a task that is run again after a lost
executor finds its rows in the same range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapledger.session import settle

LIMIT_SETTING = "spark.lapledger.groupRows"
LIMIT_DEFAULT = 1_000_000
#: Ranges for each time that the hot groups hold the limit; Spark's ranges are uneven by a small factor.
RANGES_PER_LIMIT = 4

ROWS, BLOCK, TIE = "__rows", "__block", "__tie"


class Step(NamedTuple):
    """One column: how it is computed within a block and carried over blocks.

    ``whole`` asks for the value of the whole group instead of the value so far.
    """

    kind: str
    value: Column | None = None
    whole: bool = False


def position() -> Step:
    return Step("position")


def total(value: Column, whole: bool = False) -> Step:
    return Step("total", value, whole)


def lowest(value: Column, whole: bool = False) -> Step:
    return Step("lowest", value, whole)


def highest(value: Column, whole: bool = False) -> Step:
    return Step("highest", value, whole)


def group_limit(df: DataFrame, limit: int | None = None) -> int:
    """Rows that one task may hold of one group."""
    if limit is not None:
        return limit
    return int(df.sparkSession.conf.get(LIMIT_SETTING, str(LIMIT_DEFAULT)))


def nulls_last(value: Column | str) -> list[Column]:
    """Ascending order with missing values at the end, as two ascending keys."""
    column = F.col(value) if isinstance(value, str) else value
    return [column.isNull(), column]


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Groups with more rows than one task should hold; at most (rows / limit) of them exist."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    return sizes.filter(F.col(ROWS) > group_limit(df, limit))


def any_hot(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """Is any group over the limit?

    A group of finer keys lies inside a group of coarser ones, so when the coarser keys have no hot
    group the finer ones have none either.
    """
    return not hot_groups(df, keys, limit).isEmpty()


def group_sizes(
    df: DataFrame, key_sets: Sequence[Sequence[str]], weights: Sequence[Column] | None = None
) -> tuple[int, list[int]]:
    """All rows, and the rows of the largest group of each key set, in one pass.

    ``weights`` tell for each key set how many rows a row counts as; all rows are counted by the first. Two numbers
    per key set reach the driver.
    """
    columns = list(dict.fromkeys(key for keys in key_sets for key in keys))
    weights = [F.lit(1)] * len(key_sets) if weights is None else weights
    held = [f"__rows_{i}" for i in range(len(weights))]
    weighed = df.withColumns(dict(zip(held, weights)))
    sizes = weighed.groupingSets([list(keys) for keys in key_sets], *columns).agg(
        *[F.sum(name).alias(name) for name in held], F.grouping_id().alias("__set")
    )
    found = sizes.groupBy("__set").agg(F.sum(held[0]).alias("all"), *[F.max(name).alias(name) for name in held]).collect()
    largest = {row["__set"]: row for row in found}
    # a column left out of a set puts a one into the set's number, the first column the highest bit
    numbers = [
        sum(2 ** (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        for keys in key_sets
    ]
    rows = max((row["all"] or 0 for row in found), default=0)
    return rows, [(largest[number][name] or 0) if number in largest else 0 for number, name in zip(numbers, held)]


def hot_key_sets(
    df: DataFrame, key_sets: Sequence[Sequence[str]], limit: int | None = None
) -> list[bool]:
    """``any_hot`` for several key sets in one pass."""
    bound = group_limit(df, limit)
    return [size > bound for size in group_sizes(df, key_sets)[1]]


def task_count(spark: SparkSession, rows: int, most: int) -> int:
    """Tasks with about ``most`` rows at the most; fewer rows still make up to Spark's own number of tasks."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(own, ceil(rows * 8 / most)), ceil(rows / most), 1)


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Equal keys together, in so many tasks; frames dealt alike join on these and further keys where they lie."""
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)


def attach(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys where two missing keys are equal, keeping only the left copy of the keys."""
    others = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *others)
    matches = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    )
    joined = df.join(renamed, matches, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def _in_ranges(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int
) -> DataFrame:
    """The rows of the hot groups with the number of their range, ascending within each group."""
    rows = attach(df, hot.select(*keys), keys, "left_semi")
    rows = rows.withColumn(TIE, F.xxhash64(*df.columns))
    held = hot.agg(F.sum(ROWS)).first()[0] or 0
    ranges = int(held / limit * RANGES_PER_LIMIT) + 1
    dealt = rows.repartitionByRange(ranges, *keys, *order, TIE)
    return settle(dealt.withColumn(BLOCK, F.spark_partition_id()))


def _within(step: Step, ordered) -> Column:
    """The column over an ordered window; both frames share its sort."""
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    frame = ordered.rowsBetween(first, last if step.whole else Window.currentRow)
    if step.kind == "position":
        return F.row_number().over(frame)
    apply = {"total": F.sum, "lowest": F.min, "highest": F.max}[step.kind]
    return apply(step.value).over(frame)


def _block_value(step: Step) -> Column:
    if step.kind == "position":
        return F.count(F.lit(1))
    return {"total": F.sum, "lowest": F.min, "highest": F.max}[step.kind](step.value)


def _carried(step: Step, name: str, keys: Sequence[str]) -> Column:
    """What the blocks before (for ``whole`` all blocks) of the group add up to."""
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    blocks = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(first, last if step.whole else -1)
    apply = {"position": F.sum, "total": F.sum, "lowest": F.min, "highest": F.max}[step.kind]
    return apply(F.col(name)).over(blocks)


def _combined(step: Step, here: Column, before: Column) -> Column:
    if step.whole:
        return before
    if step.kind == "position":
        return (here + F.coalesce(before, F.lit(0))).cast("int")
    if step.kind == "total":
        return F.coalesce(here + before, here, before)
    return (F.least if step.kind == "lowest" else F.greatest)(here, before)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    columns: Mapping[str, Step],
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add running columns per group in the given ascending order (its keys should be unique).

    All columns of one call share one sort, those of the whole group too. ``hot`` tells whether groups over
    the limit exist; None means look.
    """
    keys, order = list(keys), list(order)
    bound = group_limit(df, limit)
    if hot is None:
        hot = any_hot(df, keys, bound)
    ordered = Window.partitionBy(*keys).orderBy(*order)
    if not hot:
        return df.withColumns({n: _within(s, ordered) for n, s in columns.items()})

    large = settle(hot_groups(df, keys, bound))
    rest = attach(df, large.select(*keys), keys, "left_anti")
    rest = rest.withColumns({n: _within(s, ordered) for n, s in columns.items()})
    blocks = _in_ranges(df, large, keys, order, bound)
    grouped = [*keys, BLOCK]
    in_block = Window.partitionBy(*grouped).orderBy(*order, TIE)
    sums = blocks.groupBy(*grouped).agg(
        *[_block_value(s).alias(f"__b_{n}") for n, s in columns.items()]
    )
    carried = sums.select(
        *grouped, *[_carried(s, f"__b_{n}", keys).alias(f"__c_{n}") for n, s in columns.items()]
    )
    local = blocks.withColumns(
        {f"__l_{n}": F.lit(None) if s.whole else _within(s, in_block) for n, s in columns.items()}
    )
    joined = attach(local, carried, grouped)
    done = joined.withColumns(
        {n: _combined(s, F.col(f"__l_{n}"), F.col(f"__c_{n}")) for n, s in columns.items()}
    )
    return rest.unionByName(done.select(*rest.columns))


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, Column],
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add aggregates of the whole group to each of its rows.

    Hot groups are aggregated with map-side combining and joined back; the others pass a window.
    """
    keys = list(keys)
    bound = group_limit(df, limit)
    if hot is None:
        hot = any_hot(df, keys, bound)
    group = Window.partitionBy(*keys)
    if not hot:
        return df.withColumns({n: c.over(group) for n, c in columns.items()})

    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in columns.items()]
    )
    large = settle(sizes.filter(F.col(ROWS) > bound).drop(ROWS))
    rest = attach(df, large.select(*keys), keys, "left_anti")
    rest = rest.withColumns({n: c.over(group) for n, c in columns.items()})
    done = attach(df.drop(*columns), large, keys, "inner")
    return rest.unionByName(done.select(*rest.columns))


def shared_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    hot: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rank of the value, highest first, where equal values share the smallest rank.

    With hot groups the rank comes from one row per distinct value: one plus the rows above it.
    """
    keys = list(keys)
    bound = group_limit(df, limit)
    if hot is None:
        hot = any_hot(df, keys, bound)
    if not hot:
        ordered = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(name, F.rank().over(ordered))
    df = settle(df)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ROWS))
    above = running(
        counts,
        keys,
        [F.col(value).isNull(), -F.col(value)],
        {"__up_to": total(F.col(ROWS))},
        limit=bound,
    )
    ranks = above.select(*keys, value, (F.col("__up_to") - F.col(ROWS) + 1).cast("int").alias(name))
    return attach(df, ranks, [*keys, value])
