"""Rows behind the charts: bar values, labels and tooltips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.model import LAST_LEG
from lapledger.plans.reports import chosen, flag_text


def _day() -> Column:
    return F.date_format("date_ymd", "yyyy-MM-dd")


def _place_label() -> Column:
    place = F.when(F.col("overall_valid"), F.col("place_overall").cast("string")).otherwise("TBC")
    return F.concat_ws(" ", place, F.col("name"))


def _leg_line(label: str) -> Column:
    only_leg = F.col("split_valid") & ~F.col("cumulative_valid")
    return F.concat(
        F.col(label), flag_text(only_leg, " (valid)"), F.lit(": "), F.col("duration_hms_short")
    )


def _cumulative_line() -> Column:
    only_sum = F.col("cumulative_valid") & ~F.col("split_valid")
    return F.concat(
        F.lit("Cumulative"),
        flag_text(F.col("cumulative_valid"), "", " (invalid)"),
        flag_text(only_sum, " (valid)"),
        F.lit(": "),
        F.col("cumulative_hms_short"),
    )


def _in_brackets(shown: Column, text: Column) -> Column:
    bracketed = F.concat(F.lit(" ("), text, F.lit(")"))
    return F.when(F.coalesce(shown, F.lit(False)), bracketed).otherwise("")


def race_bars(
    facts: DataFrame,
    season: str | None = None,
    race: int | None = None,
    course: str | None = None,
    champ: bool | None = None,
) -> DataFrame:
    """Leg minutes of each competitor of a race with place label and tooltip."""
    rows = chosen(
        facts.filter("started"), season=season, race_number=race, course=course, is_champ=champ
    )
    best = F.when(
        F.col("season_pb_leg"),
        flag_text(F.col("record_rank_leg") == 1, " Season record!", " Season PB!"),
    ).otherwise("")
    tooltip = F.concat(
        F.col("name"),
        flag_text(F.col("first_race") & (F.col("race_number") != 1), " - First race this season"),
        F.lit("\n"),
        _leg_line("display_class"),
        _in_brackets(F.col("split_valid"), F.col("place_leg_nice")),
        flag_text(F.col("new_pb_leg") & ~F.col("season_pb_leg"), " New PB!"),
        best,
        F.lit("\n"),
        _cumulative_line(),
        _in_brackets(F.col("cumulative_valid"), F.col("place_cumulative_nice")),
        flag_text(F.col("new_pb_cumulative"), " New PB!"),
    )
    return rows.select(
        "season",
        "race_number",
        "course",
        "is_champ",
        "name",
        "part",
        "display_class",
        "duration_mins",
        "place_overall",
        _place_label().alias("place_name"),
        tooltip.alias("tooltip"),
    )


def record_bars(
    facts: DataFrame, season: str | None = None, course: str | None = None
) -> DataFrame:
    """Leg minutes of each competitor's season best with its rank and tooltip."""
    rows = chosen(
        facts.filter(F.col("started") & F.col("season_pb_overall")), season=season, course=course
    )
    tooltip = F.concat(
        F.col("name"),
        F.lit("\nRace #: "),
        F.col("race_number").cast("string"),
        F.lit("\nDate: "),
        _day(),
        F.lit("\n"),
        _leg_line("display_class"),
        flag_text(F.col("season_pb_leg"), " PB!"),
        flag_text(F.col("record_rank_leg") == 1, " Season record!"),
        F.lit("\n"),
        _cumulative_line(),
    )
    return rows.select(
        "season",
        "course",
        "race_number",
        "is_champ",
        "name",
        "part",
        "display_class",
        "duration_mins",
        "record_rank_overall",
        F.concat_ws(" ", F.col("record_rank_overall").cast("string"), "name").alias("place_name"),
        tooltip.alias("tooltip"),
    )


def athlete_bars(
    facts: DataFrame, name: str | None = None, season: str | None = None
) -> DataFrame:
    """Leg minutes per race of a competitor, of one season or all, with course letter and tooltip."""
    rows = chosen(facts, name=name, season=season)
    # Letters of the courses other than full.
    letter = (
        F.when(F.col("course") == "double", "D")
        .when(F.col("course") == "int", "I")
        .when(F.col("course") == "teams", "T")
    )
    label = F.when(F.col("part") == LAST_LEG, letter)
    head = F.concat(
        F.lit("Race #: "),
        F.col("race_number").cast("string"),
        F.lit("\nDate: "),
        _day(),
        F.lit("\nCourse: "),
        F.col("course_nice"),
        F.lit("\n"),
    )
    timed = F.concat(
        head,
        _leg_line("display_class_pb"),
        flag_text(F.col("new_pb_leg") & ~F.col("season_pb_leg"), " New PB!"),
        flag_text(F.col("season_pb_leg"), " Season PB!"),
        flag_text(F.col("record_rank_leg") == 1, " Season record!"),
        F.lit("\n"),
        _cumulative_line(),
        flag_text(F.col("new_pb_cumulative"), " New PB!"),
    )
    team = F.concat(head, F.lit("No timing available"))
    return rows.select(
        "name",
        "season",
        "race_number",
        "is_champ",
        "course",
        "part",
        "display_class_pb",
        "duration_mins",
        label.alias("plot_label"),
        F.when(label.isNotNull(), F.coalesce("overall_mins", F.lit(0.0))).alias("label_height"),
        _place_label().alias("place_name"),
        F.when(F.col("course") == "teams", team).otherwise(timed).alias("tooltip"),
    )
