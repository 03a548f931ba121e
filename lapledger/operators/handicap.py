"""Handicap start times from the best times of recent seasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.functions.times import seconds_hms, unpadded_time
from lapledger.operators.aggregates import best_times
from lapledger.operators.clean import clean_names
from lapledger.operators.joins import apply_aliases, attach_handicap


def handicap_window(
    facts: DataFrame, calendar: DataFrame, last_race: str | None = None, seasons_back: int = 3
) -> DataFrame:
    """Facts with handicap_eligible and season_current.

    The current season is the first with a race after ``last_race`` (by default the last date with
    results). Eligible are valid efforts up to that date, of this season or of the
    ``seasons_back`` latest seasons before it that have facts.
    """
    held = calendar.agg(F.max(F.when(F.col("have_results"), F.col("date_ymd"))))
    latest = F.lit(last_race).cast("date") if last_race else held.scalar()
    current = calendar.agg(F.min(F.when(F.col("date_ymd") > latest, F.col("season")))).scalar()
    # seasons are few, one row each, so ordering them in one place is small
    seasons = facts.select("season").distinct().filter(F.col("season") < current)
    recent = seasons.orderBy(F.col("season").desc()).limit(seasons_back)
    oldest = recent.agg(F.min("season")).scalar()
    in_window = (F.col("season") == current) | (
        (F.col("season") < current) & (F.col("season") >= oldest)
    )
    usable = F.col("overall_valid") & (F.col("date_ymd") <= latest) & in_window
    return facts.withColumns(
        {"season_current": current, "handicap_eligible": F.coalesce(usable, F.lit(False))}
    )


def handicap_best(windowed: DataFrame, penalty_min: float = 3.0) -> DataFrame:
    """Best time per competitor and course, times of earlier seasons made ``penalty_min`` longer."""
    per_season = best_times(
        windowed.withColumn("__was", F.col("season") != F.col("season_current")).withColumn(
            "overall_mins",
            F.when(F.col("__was"), F.col("overall_mins") + penalty_min).otherwise(
                F.col("overall_mins")
            ),
        )
    )
    return per_season.groupBy("name", "course").agg(
        F.min("best_time_mins").alias("best_time_mins_adjust"),
        F.min("name_last").alias("name_last"),
        F.min("name_first").alias("name_first"),
    )


def start_times(best: DataFrame, target_hour: float = 7.5) -> DataFrame:
    """Start so that the adjusted best time ends at ``target_hour``; seconds are cut off in texts."""
    start = best.withColumn("start_time_mins", F.lit(target_hour * 60) - F.col("best_time_mins_adjust"))
    return start.withColumns(
        {
            "best_time_adjust_hms": seconds_hms(F.col("best_time_mins_adjust") * 60, "floor", False),
            "start_time_hms": seconds_hms(F.col("start_time_mins") * 60, "floor", False),
        }
    )


def handicaps(
    facts: DataFrame,
    calendar: DataFrame,
    last_race: str | None = None,
    seasons_back: int = 3,
    penalty_min: float = 3.0,
    target_hour: float = 7.5,
) -> DataFrame:
    """Window, best times and start times in one call."""
    windowed = handicap_window(facts, calendar, last_race, seasons_back)
    return start_times(handicap_best(windowed, penalty_min), target_hour)


def handicap_table(starts: DataFrame, course: str | Sequence[str] | None = None) -> DataFrame:
    """Start times by name, without the leading zero of the hour."""
    courses = [course] if isinstance(course, str) else course
    chosen = starts if courses is None else starts.filter(F.col("course").isin(*courses))
    return chosen.select(
        "course",
        "name",
        "name_last",
        "name_first",
        unpadded_time(F.col("best_time_adjust_hms")).alias("best_time"),
        unpadded_time(F.col("start_time_hms")).alias("start_time"),
    ).orderBy("name_last", "name_first", "course")


# Course names on start lists and their course codes.
START_LIST_COURSES = {"Full": "full", "Intermediate": "int", "Double Distance": "double"}


def start_list(entrants: DataFrame, starts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Entrants with standard names and their start time, null without a past result."""
    named = apply_aliases(clean_names(entrants, split=False), aliases)
    code = F
    for label, course in START_LIST_COURSES.items():
        code = code.when(F.col("course") == label, course)
    coded = named.withColumn("course_listed", F.col("course")).withColumn(
        "course", code.otherwise(F.lower("course"))
    )
    joined = attach_handicap(coded, starts)
    return joined.select(
        "name",
        "chip",
        F.col("course_listed").alias("course"),
        F.col("start_time_hms").alias("start_time"),
    )
