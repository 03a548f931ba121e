"""Joins that copy columns from a lookup table, and membership tests.

No join carries a broadcast hint: Spark knows the size of the lookup's files and broadcasts the small
ones by itself; a large one is shuffled, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.functions.names import standard_name
from lapledger.model import EFFORT
from lapledger.operators.reshape import legs_unpacked


#: The column that readers give rows their place in the files with.
POSITION = "position"


def last_match(df: DataFrame, on: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key, so that a join keeps the row count: the one with the largest ``order``.

    Without an order the last row by ``position`` wins where the rows have one, as in lists read from files, else
    the largest row, which is the same row in every run. The position goes.
    """
    if order is None and POSITION in df.columns and POSITION not in on:
        order = POSITION
    others = [c for c in df.columns if c not in on and c != POSITION]
    if not others:
        return df.select(*on).distinct()
    row = F.struct(*[F.col(c) for c in others])
    kept = F.max_by(row, F.struct(F.col(order), row)) if order else F.max(row)
    return df.groupBy(*on).agg(kept.alias("__row")).select(*on, *[F.col(f"__row.{c}") for c in others])


def positioned(df: DataFrame) -> list[str]:
    """The column that tells which row of a key is the last, if there is one."""
    return [POSITION] if POSITION in df.columns else []


def attach_columns(
    df: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    order: str | None = None,
) -> DataFrame:
    """Left join of the last matching row; columns the left side already has are replaced."""
    extra = [order] if order and order not in columns else positioned(right)
    lookup = last_match(right.select(*on, *columns, *extra), on, order).select(*on, *columns)
    return df.drop(*columns).join(lookup, list(on), "left")


def attach_calendar(
    df: DataFrame,
    calendar: DataFrame,
    on: Sequence[str] = ("date_ymd", "course", "is_champ"),
    columns: Sequence[str] = ("season", "race_number", "course_nice", "race_type"),
) -> DataFrame:
    """Copy calendar columns to rows of the race."""
    return attach_columns(df, calendar, on, columns)


def apply_aliases(df: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """Replace names whose lower-case form has a correction, the last one; the result is standardised as well."""
    fixes = aliases.select(F.lower("name_in").alias("__key"), F.col("name_out").alias("__out"), *positioned(aliases))
    fixes = last_match(fixes, ["__key"])
    keyed = df.withColumn("__key", F.lower(name)).join(fixes, "__key", "left")
    fixed = F.coalesce(standard_name(F.col("__out")), F.col(name))
    return keyed.withColumn(name, fixed).select(*df.columns)


def attach_problems(
    df: DataFrame, problems: DataFrame, on: Sequence[str] = (*EFFORT, "part")
) -> DataFrame:
    """Validity flags of listed legs; legs without a problem are valid.

    The last of ``on`` tells the legs of an effort apart. Flags come as a map of an effort's legs, so that rows
    that lie by effort already need not be dealt out again by leg. Packed legs meet the map as an effort's one row and
    get rows of their own after that.
    """
    flags = ["split_valid", "cumulative_valid"]
    *effort, leg = on
    listed = problems.filter(F.col(leg).isNotNull()).select(*on, *flags, *positioned(problems))
    entry = F.struct(F.col(leg), F.struct(*flags))
    legs = last_match(listed, on).groupBy(*effort).agg(F.map_from_entries(F.collect_list(entry)).alias("__legs"))
    joined = legs_unpacked(df.drop(*flags).join(legs, effort, "left"))
    found = F.try_element_at(F.col("__legs"), F.col(leg))
    return joined.withColumns({f: F.coalesce(found[f], F.lit(True)) for f in flags}).drop("__legs")


def attach_prehistory(
    df: DataFrame, prehistory: DataFrame, newcomers: DataFrame | None = None, name: str = "name"
) -> DataFrame:
    """Entries before the detailed seasons; confirmed newcomers have none."""
    joined = attach_columns(df, prehistory, [name], ["entries_before"])
    if newcomers is None:
        return joined
    new = newcomers.select(name).distinct().withColumn("__new", F.lit(True))
    known = joined.join(new, name, "left")
    zero = F.when(F.col("__new"), F.lit(0)).otherwise(F.col("entries_before"))
    return known.withColumn("entries_before", zero.cast("long")).drop("__new")


def attach_links(summary: DataFrame, facts: DataFrame, name: str = "name") -> DataFrame:
    """Page link of competitors with detailed results; the plain name for the others."""
    links = facts.groupBy(name).agg(F.max("athlete_link").alias("athlete_link"))
    joined = summary.join(links, name, "left")
    return joined.withColumn("athlete_link", F.coalesce("athlete_link", F.col(name)))


def attach_handicap(
    entrants: DataFrame,
    handicaps: DataFrame,
    on: Sequence[str] = ("name", "course"),
    columns: Sequence[str] = ("best_time_mins_adjust", "start_time_mins", "start_time_hms"),
) -> DataFrame:
    return attach_columns(entrants, handicaps, on, columns)


def attach_race_entries(
    calendar: DataFrame,
    entries: DataFrame,
    on: Sequence[str] = ("season", "race_number"),
    columns: Sequence[str] = ("entries", "first_timers"),
) -> DataFrame:
    return attach_columns(calendar, entries, on, columns)


def members(df: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``right``."""
    return df.join(right.select(*on), list(on), "left_semi")


def non_members(df: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``right``."""
    return df.join(right.select(*on), list(on), "left_anti")
