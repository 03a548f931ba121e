"""Frames of the race and season animations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.model import LEGS
from lapledger.operators.ranks import alphabetic_place, place_change
from lapledger.plans.reports import chosen

# Per stage the number of legs whose bars are out, and by which leg rows are ordered.
BARS_OUT = (0, 1, 1, 2, 2, 3, 3)
ORDERED_BY = (0, 0, 1, 1, 2, 2, 3)
RACE_KEYS = ("season", "race_number", "course", "is_champ")


def frame_expansion(df: DataFrame, stages: Column | Sequence[int], to: str = "stage") -> DataFrame:
    """Each row once per stage; an explode, so no join is involved."""
    values = stages if isinstance(stages, Column) else F.array(*[F.lit(s) for s in stages])
    return df.withColumn(to, F.explode(values))


def race_replay(
    facts: DataFrame,
    date=None,
    course: str | None = None,
    champ: bool | None = None,
    hot: bool | None = None,
) -> DataFrame:
    """Seven stages per competitor and leg: bar width, vertical place and place change.

    The bars grow and the rows reorder leg by leg: first by surname, then by the place at each leg.
    """
    rows = chosen(facts.filter("started"), date_ymd=date, course=course, is_champ=champ)
    named = alphabetic_place(rows, [*RACE_KEYS, "part"], hot=hot)
    legs = {
        f"__{what}_{leg}": F.max(F.when(F.col("part") == leg, F.col(column)))
        for leg in LEGS
        for what, column in (("mins", "cumulative_mins"), ("place", "place_cumulative"))
    }
    effort = [*RACE_KEYS, "date_ymd", "name"]
    known = spread.group_values(named, effort, legs, hot)
    frames = frame_expansion(known, range(1, 8))
    number = F.array_position(F.array(*[F.lit(leg) for leg in LEGS]), F.col("part")).cast("int")
    out = F.get(F.array(*[F.lit(v) for v in BARS_OUT]), F.col("stage") - 1)

    def at_leg(what: str, leg: Column) -> Column:
        return F.get(F.array(*[F.col(f"__{what}_{name}") for name in LEGS]), leg - 1)

    def place_at(stage: Column) -> Column:
        by = F.get(F.array(*[F.lit(v) for v in ORDERED_BY]), stage - 1)
        return F.when(by == 0, F.col("alphabetic_place")).otherwise(at_leg("place", by))

    width = F.when(out == 0, F.lit(0.0)).otherwise(at_leg("mins", F.least(number, out)))
    staged = frames.withColumns({"width": width, "place": place_at(F.col("stage"))})
    # seven frames a row are made from the row alone, so they are neither sorted nor written on the way
    changed = place_change(staged, [*effort, "part"], before=place_at(F.col("stage") - 2))
    return changed.select(
        *RACE_KEYS,
        "date_ymd",
        "name",
        "part",
        "stage",
        "display_class",
        "width",
        "place",
        "place_diff",
        "change_type",
        "change_text",
    )


def participation_replay(progress: DataFrame, season: str | None = None) -> DataFrame:
    """The season after each race: later races are empty, the summary stands on the current race.

    ``progress`` comes from ``race_progress``: one row per race, so frames are races x races of a season.
    """
    races = chosen(progress, season=season)
    last = races.groupBy("season").agg(
        F.max(F.when(F.col("have_results"), F.col("race_number"))).alias("__last")
    )
    frames = frame_expansion(
        races.join(last.filter("__last is not null"), "season"),
        F.sequence(F.lit(0), F.col("__last").cast("int")),
    )
    later = F.col("race_number") > F.col("stage")
    current = F.col("race_number") == F.col("stage")
    return frames.select(
        "season",
        "stage",
        "race_number",
        F.when(later, F.lit(0)).otherwise(F.col("entries")).cast("long").alias("entries"),
        F.when(~later, F.col("entries_label")).cast("long").alias("entries_label"),
        F.when(~later, F.col("reason_sign")).alias("reason_sign"),
        (6 - 3 * (F.col("race_number") % 2)).cast("int").alias("sign_height"),
        F.when(current, F.col("summary_text")).alias("summary_text"),
    )
