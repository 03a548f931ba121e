"""Conditional updates of columns: defaults, flags, overrides and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.model import FIRST_LEG
from lapledger.operators.joins import last_match, positioned

VALID_FLAGS = ("split_valid", "cumulative_valid", "overall_valid")


def default_flags(df: DataFrame, defaults: Mapping[str, bool]) -> DataFrame:
    """Missing flags get their default."""
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def mark_started(df: DataFrame, first_leg: str = FIRST_LEG) -> DataFrame:
    """Blank or "-" in the first leg means not started; a missing first leg counts as started."""
    absent = F.coalesce(F.col(first_leg).isin("", "-"), F.lit(False))
    return df.withColumn("started", ~absent)


def cast_places(df: DataFrame, place: str = "place", to: str = "place_import") -> DataFrame:
    """Place text as a number; "-" and other texts become null."""
    return df.withColumn(to, F.col(place).try_cast("double"))


def apply_overrides(
    df: DataFrame, overrides: DataFrame, on: Sequence[str], set_cols: Sequence[str]
) -> DataFrame:
    """Rows with an entry in ``overrides`` take the values of the last one, also where a value is null."""
    fixes = last_match(overrides.select(*on, *set_cols, *positioned(overrides)), on).select(
        *on, *[F.col(c).alias(f"__set_{c}") for c in set_cols], F.lit(True).alias("__found")
    )
    joined = df.join(fixes, list(on), "left")
    changed = joined.withColumns(
        {c: F.when(F.col("__found"), F.col(f"__set_{c}")).otherwise(F.col(c)) for c in set_cols}
    )
    return changed.select(*df.columns)


def invalidate(
    df: DataFrame, bad_races: DataFrame | None = None, on: str = "date_ymd"
) -> DataFrame:
    """Participation-only rows and all rows of the listed races lose every validity flag."""
    lost = F.coalesce(F.col("participation_only"), F.lit(False))
    joined = df
    if bad_races is not None:
        bad = bad_races.select(on).distinct().withColumn("__bad", F.lit(True))
        joined = df.join(F.broadcast(bad), on, "left")
        lost = lost | F.col("__bad").isNotNull()
    known = [flag for flag in VALID_FLAGS if flag in df.columns]
    flags = {f: F.when(lost, F.lit(False)).otherwise(F.col(f)) for f in known}
    return joined.withColumns(flags).select(*df.columns)


def time_of_day_fix(
    df: DataFrame,
    races: DataFrame,
    overall: str = "time_overall_import",
    leg_time: str = "duration_import",
    on: str = "date_ymd",
) -> DataFrame:
    """Listed races recorded the clock: a leading 7 becomes 1 and the first leg takes that time."""
    listed = races.select(on).distinct().withColumn("__clock", F.lit(True))
    joined = df.join(F.broadcast(listed), on, "left")
    clock = F.col("__clock").isNotNull()
    fixed = joined.withColumn(
        overall,
        F.when(clock, F.regexp_replace(F.col(overall), "^7", "1")).otherwise(F.col(overall)),
    )
    first = clock & (F.col("part") == FIRST_LEG)
    fixed = fixed.withColumn(leg_time, F.when(first, F.col(overall)).otherwise(F.col(leg_time)))
    return fixed.select(*df.columns)


def mask_invalid(df: DataFrame, masks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """New column → (value, flag): the value where the flag is true, else null."""
    return df.withColumns({n: F.when(F.col(f), F.col(v)) for n, (v, f) in masks.items()})


def when_all(*conditions: Column) -> Column:
    """All conditions hold, with missing ones counted as false."""
    held = F.lit(True)
    for condition in conditions:
        held = held & F.coalesce(condition, F.lit(False))
    return held
