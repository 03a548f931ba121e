"""Report tables from the facts.

Each report takes optional filters. Without them it returns all races, courses or competitors at
once, with their keys as columns, which is how a whole season is published in one job. Filters reach
the Parquet scan of a saved fact table, the season as a partition filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.functions.texts import counted
from lapledger.functions.times import seconds_hms
from lapledger.model import FIRST_LEG
from lapledger.operators.aggregates import milestones
from lapledger.operators.ranks import leaderboard_rank
from lapledger.operators.reshape import legs_wide
from lapledger.operators.update import apply_overrides


def chosen(df: DataFrame, **filters) -> DataFrame:
    """Rows where each named column has the given value; None leaves a column free."""
    for column, value in filters.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def race_table(
    facts: DataFrame,
    season: str | None = None,
    race: int | None = None,
    course: str | None = None,
    champ: bool | None = None,
) -> DataFrame:
    """Rank, name, total, legs, leg places and flags of each started competitor of a race."""
    rows = chosen(
        facts.filter("started"), season=season, race_number=race, course=course, is_champ=champ
    )
    wide = legs_wide(
        rows,
        [
            "season",
            "race_number",
            "course",
            "is_champ",
            "date_ymd",
            "name",
            "athlete_link",
            "place_overall",
            "effort_rank_overall",
            "total_overall_hms",
            "overall_valid",
            "season_pb_overall",
            "record_rank_overall",
        ],
        ["duration_hms", "place_leg", "effort_rank_leg", "season_pb_leg", "split_valid", "record_rank_leg"],
    )
    return wide.orderBy("season", "race_number", "course", "is_champ", "place_overall")


def team_table(
    facts: DataFrame, season: str | None = None, race: int | None = None
) -> DataFrame:
    """One row per team with its racers by slot."""
    rows = chosen(
        facts.filter((F.col("course") == "teams") & F.col("started") & (F.col("part") == FIRST_LEG)),
        season=season,
        race_number=race,
    )
    slots = [
        F.max(F.when(F.col("racer_ref") == f"Racer {i}", F.col("athlete_link"))).alias(f"racer_{i}")
        for i in (1, 2, 3)
    ]
    teams = rows.groupBy("season", "race_number", "team_number").agg(*slots)
    return teams.orderBy("season", "race_number", "team_number")


def participants_table(
    facts: DataFrame,
    season: str | None = None,
    race: int | None = None,
    course: str | None = None,
    champ: bool | None = None,
) -> DataFrame:
    """Names only, by surname."""
    rows = chosen(
        facts.filter(F.col("part") == FIRST_LEG),
        season=season,
        race_number=race,
        course=course,
        is_champ=champ,
    )
    return rows.select(
        "season", "race_number", "course", "is_champ", "name_last", "athlete_link"
    ).orderBy("season", "race_number", "course", "is_champ", "name_last", "athlete_link")


RECORD_KEYS = (
    "season",
    "course",
    "record_rank_overall",
    "name",
    "athlete_link",
    "total_overall_hms",
    "race_link",
    "race_number",
    "is_champ",
    "overall_valid",
    "season_pb_overall",
)
RECORD_VALUES = ("duration_hms", "season_pb_leg", "split_valid", "record_rank_leg")


def record_table_overall(
    facts: DataFrame, season: str | None = None, course: str | None = None
) -> DataFrame:
    """Each competitor's season best of a course, ranked."""
    rows = chosen(
        facts.filter(F.col("started") & F.col("season_pb_overall")), season=season, course=course
    )
    wide = legs_wide(rows, RECORD_KEYS, RECORD_VALUES)
    return wide.orderBy("season", "course", "record_rank_overall", "name")


def record_table_leg(
    facts: DataFrame, leg: str, season: str | None = None, course: str | None = None
) -> DataFrame:
    """The efforts that hold a competitor's best of one leg, ranked by that leg."""
    rows = chosen(
        facts.filter(F.col("started") & F.col("effort_has_pb")), season=season, course=course
    )
    wide = legs_wide(rows, RECORD_KEYS, RECORD_VALUES)
    ranked = wide.filter(F.col(f"season_pb_leg_{leg}"))
    return ranked.orderBy("season", "course", f"record_rank_leg_{leg}", "name")


def athlete_course_table(
    facts: DataFrame,
    name: str | None = None,
    season: str | None = None,
    course: str | None = None,
) -> DataFrame:
    """A competitor's efforts of a season and course by own rank."""
    rows = chosen(facts.filter("started"), name=name, season=season, course=course)
    wide = legs_wide(
        rows,
        [
            "name",
            "season",
            "course",
            "effort_rank_overall",
            "total_overall_hms",
            "race_link",
            "race_number",
            "is_champ",
            "overall_valid",
            "season_pb_overall",
            "record_rank_overall",
        ],
        ["duration_hms", "effort_rank_leg", "season_pb_leg", "split_valid", "record_rank_leg"],
    )
    return wide.orderBy("name", "season", "course", "effort_rank_overall")


def athlete_table(facts: DataFrame, name: str | None = None) -> DataFrame:
    """All efforts of a competitor, latest first."""
    wide = legs_wide(
        chosen(facts, name=name),
        [
            "name",
            "season",
            "race_link",
            "date_ymd",
            "course",
            "course_nice",
            "is_champ",
            "total_overall_hms",
            "overall_valid",
            "season_pb_overall",
            "record_rank_overall",
        ],
        ["duration_hms", "season_pb_leg", "split_valid", "record_rank_leg"],
    )
    return wide.orderBy("name", F.col("date_ymd").desc())


def season_leaderboard(facts: DataFrame, season: str | None = None) -> DataFrame:
    """Rank, total and full-or-double total per competitor of a season."""
    rows = chosen(
        facts.filter(F.col("is_last_entry") & (F.col("part") == FIRST_LEG)), season=season
    )
    each = rows.groupBy("season", "name").agg(
        F.max("entries_total").alias("entries_total"),
        F.max("entries_total_fd").alias("entries_total_fd"),
        F.max("name_last").alias("name_last"),
        F.max("athlete_link").alias("athlete_link"),
    )
    ranked = leaderboard_rank(each, ["season"], "entries_total", "entries_total_rank")
    return ranked.orderBy("season", F.col("entries_total").desc(), "name_last", "name")


def career_leaderboard(facts: DataFrame) -> DataFrame:
    """The same over all seasons, from one row per competitor."""
    rows = facts.filter(F.col("is_last_entry_all") & (F.col("part") == FIRST_LEG))
    each = rows.groupBy("name").agg(
        F.max("entries_total_all").alias("entries_total_all"),
        F.max("entries_total_all_fd").alias("entries_total_all_fd"),
        F.max("name_last").alias("name_last"),
        F.max("athlete_link").alias("athlete_link"),
    )
    # all competitors are one group: distinct totals are ranked, not rows
    one = each.withColumn("__all", F.lit(1))
    ranked = leaderboard_rank(one, ["__all"], "entries_total_all", "entries_total_all_rank", hot=True)
    return ranked.drop("__all").orderBy(F.col("entries_total_all").desc(), "name_last", "name")


def career_table(careers: DataFrame, milestone: bool = False, every: int = 50) -> DataFrame:
    """Totals, seasons, first and latest season, most entries first; or those near a milestone."""
    if milestone:
        return milestones(careers, "entries_fd", every)
    return careers.orderBy(F.col("entries").desc(), "name")


def entries_over_time(facts: DataFrame, season: str | None = None) -> DataFrame:
    """Running entries per competitor and race with tooltip."""
    rows = chosen(facts.filter(F.col("part") == FIRST_LEG), season=season)
    text = F.concat(
        F.col("name"),
        F.lit("\nRace #: "),
        F.col("race_number").cast("string"),
        F.lit("\nDate: "),
        F.date_format("date_ymd", "yyyy-MM-dd"),
        F.lit("\nEntries so far: "),
        F.col("entries_cumulative").cast("string"),
    )
    return rows.select(
        "season", "race_number", "name", "name_last", "entries_cumulative", text.alias("tooltip")
    )


def athlete_index(facts: DataFrame) -> DataFrame:
    """Competitors by initial of the surname, one row each, "Unknown" for those without."""
    each = facts.groupBy("name").agg(
        F.min("name_last").alias("name_last"),
        F.min("name_first").alias("name_first"),
        F.min("athlete_ref").alias("athlete_ref"),
    )
    initial = F.when(F.col("name_last") == "", "Unknown").otherwise(F.substring("name_last", 1, 1))
    link = F.concat(F.lit("["), F.col("name"), F.lit("](#"), F.col("athlete_ref"), F.lit(")"))
    listed = each.select(
        initial.alias("initial"), "name", "name_last", "name_first", link.alias("link")
    )
    return listed.orderBy(F.col("name_last") == "", "name_last", "name_first", "name")


def athlete_headline(facts: DataFrame, careers: DataFrame) -> DataFrame:
    """"<first name> has N entries." per competitor."""
    each = facts.groupBy("name").agg(F.min("name_first").alias("name_first"))
    joined = each.join(careers.select("name", "entries"), "name")
    text = F.concat(
        F.col("name_first"), F.lit(" has "), counted(F.col("entries"), "entry", "entries"), F.lit(".")
    )
    return joined.select("name", "entries", text.alias("sentence"))


def season_best_export(
    facts: DataFrame,
    season: str | None = None,
    course: str | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Season best per competitor with a numeric bib, in bib order, those without a bib last.

    ``overrides`` (name, bib) replaces bibs, also by none.
    """
    rows = chosen(
        facts.filter(
            F.col("started") & F.col("season_pb_overall") & (F.col("part") == FIRST_LEG)
        ),
        season=season,
        course=course,
    )
    bests = rows.select(
        "season",
        "course",
        F.col("bib").try_cast("int").alias("bib"),
        "name",
        seconds_hms(F.col("overall_seconds")).alias("best_time_hms"),
    )
    if overrides is not None:
        bests = apply_overrides(bests, overrides, ["name"], ["bib"])
    return bests.orderBy(F.col("bib").asc_nulls_last(), "name")


def flag_text(condition: Column, text: str, otherwise: str = "") -> Column:
    """The text where the condition holds, else the other; a missing condition counts as false."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(text)).otherwise(F.lit(otherwise))


