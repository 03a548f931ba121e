"""Participation: running entries, totals and last entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.model import FULL_AND_DOUBLE

SEASON = ("name", "season")
IN_ORDER = ("date_ymd", "course", "is_champ")


def _count(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def running_entries(
    df: DataFrame,
    partition: Sequence[str] = (*SEASON, "part"),
    order: Sequence[str] = IN_ORDER,
    counted: str | Column = "started",
    to: str = "entries_cumulative",
    hot: bool | None = None,
) -> DataFrame:
    """Entries so far in date order."""
    condition = F.col(counted) if isinstance(counted, str) else counted
    by = [F.col(c) for c in order]
    return spread.running(df, partition, by, {to: spread.total(_count(condition))}, hot)


def running_entries_fd(
    df: DataFrame,
    partition: Sequence[str] = (*SEASON, "part"),
    order: Sequence[str] = IN_ORDER,
    courses: Sequence[str] = FULL_AND_DOUBLE,
    to: str = "entries_cumulative_fd",
    hot: bool | None = None,
) -> DataFrame:
    """Entries so far on the full and double courses."""
    return running_entries(df, partition, order, F.col("course").isin(*courses), to, hot)


def season_totals(
    df: DataFrame,
    partition: Sequence[str] = SEASON,
    columns: dict[str, str] | None = None,
    hot: bool | None = None,
) -> DataFrame:
    """The largest running count, on every row of the season."""
    columns = columns or {"entries_total": "entries_cumulative"}
    return spread.group_values(df, partition, {to: F.max(c) for to, c in columns.items()}, hot)


def last_entry(
    df: DataFrame,
    partition: Sequence[str] = SEASON,
    order: str = "race_number",
    to: str = "is_last_entry",
    hot: bool | None = None,
) -> DataFrame:
    """Is this the latest race of the season (or, with the name alone, of all)?"""
    latest = spread.group_values(df, partition, {"__latest": F.max(order)}, hot)
    return latest.withColumn(to, F.col(order) == F.col("__latest")).drop("__latest")


def career_entries(
    df: DataFrame,
    partition: Sequence[str] = ("name", "part"),
    order: Sequence[str] = IN_ORDER,
    counted: str | Column = "started",
    before: str = "entries_before",
    to: str = "entries_cumulative_all",
    legacy: bool = False,
    hot: bool | None = None,
) -> DataFrame:
    """Entries so far in all seasons, earlier ones included once.

    ``legacy`` adds the earlier entries anew at every race, as the published totals did.
    """
    counts = running_entries(df, partition, order, counted, to, hot)
    if not legacy:
        return counts.withColumn(to, F.col(to) + F.col(before))
    by = [F.col(c) for c in order]
    races = spread.running(counts, partition, by, {"__races": spread.total(F.lit(1))}, hot)
    return races.withColumn(to, F.col(to) + F.col("__races") * F.col(before)).drop("__races")


def career_entries_fd(
    df: DataFrame,
    partition: Sequence[str] = ("name", "part"),
    order: Sequence[str] = IN_ORDER,
    courses: Sequence[str] = FULL_AND_DOUBLE,
    before: str = "entries_before",
    to: str = "entries_cumulative_all_fd",
    hot: bool | None = None,
) -> DataFrame:
    """The same for the full and double courses."""
    condition = F.col("course").isin(*courses)
    return career_entries(df, partition, order, condition, before, to, hot=hot)


def first_race(
    df: DataFrame, running: str = "entries_cumulative", to: str = "first_race"
) -> DataFrame:
    """The first started race of the season."""
    return df.withColumn(to, F.col(running) == 1)
