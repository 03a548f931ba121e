"""Legs between rows and columns, unions and distinct entities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.model import LEGS


def legs_long(
    df: DataFrame,
    ids: Sequence[str],
    legs: Sequence[str] = LEGS,
    value: str = "duration_import",
    leg: str = "part",
) -> DataFrame:
    """One row per leg."""
    return df.unpivot(list(ids), list(legs), leg, value)


#: The legs of an effort while they travel in one row.
PACKED_LEGS = "legs"


def legs_packed(
    df: DataFrame,
    ids: Sequence[str],
    legs: Sequence[str] = LEGS,
    value: str = "duration_import",
    leg: str = "part",
) -> DataFrame:
    """One row as before, with its legs in an array; ``legs_unpacked`` makes the rows of ``legs_long`` of it."""
    each = [F.struct(F.lit(name).alias(leg), F.col(name).cast("string").alias(value)) for name in legs]
    return df.select(*ids, F.array(*each).alias(PACKED_LEGS))


def legs_unpacked(df: DataFrame) -> DataFrame:
    """One row per packed leg; rows whose legs are not packed stay as they are."""
    if PACKED_LEGS not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != PACKED_LEGS], F.inline(PACKED_LEGS))


def legs_wide(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    leg: str = "part",
    legs: Sequence[str] = LEGS,
) -> DataFrame:
    """One row per key with a column ``<value>_<leg>`` each; one aggregation, null where no leg is."""
    cells = [
        F.max(F.when(F.col(leg) == name, F.col(value))).alias(f"{value}_{name}")
        for value in values
        for name in legs
    ]
    return df.groupBy(*keys).agg(*cells)


def union_fill(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_entities(df: DataFrame, entity: str = "name", surname: str = "name_last") -> DataFrame:
    """Each entity once, by surname, those without a surname last."""
    found = df.groupBy(entity).agg(F.min(surname).alias(surname))
    return found.orderBy(F.col(surname) == "", F.lower(surname), entity)
