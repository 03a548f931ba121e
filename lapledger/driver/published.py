"""Report tables, chart rows and replay frames from the saved fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapledger.driver.registry import query
from lapledger.driver.summaries import (
    FIRST_SQL,
    PROGRESS_SQL,
    careers,
    careers_sql,
    progress,
)
from lapledger.driver.views import (
    CALENDAR_SQL,
    EFFORTS_SQL,
    efforts,
    facts_sql,
    hms_sql,
    saved_facts,
    sql,
    table,
)
from lapledger.model import LEGS
from lapledger.operators.clean import split_names
from lapledger.plans import charts, replay, reports


def wide_sql(keys: str, values: tuple[str, ...], where: str = "true", having: str = "true") -> str:
    cells = ", ".join(
        f"max(CASE WHEN part = '{leg}' THEN {value} END) AS \"{value}_{leg}\""
        for value in values
        for leg in LEGS
    )
    return facts_sql(
        f"SELECT {keys}, {cells} FROM facts WHERE {where} GROUP BY {keys} HAVING {having}"
    )


RACE_VALUES = (
    "duration_hms",
    "place_leg",
    "effort_rank_leg",
    "season_pb_leg",
    "split_valid",
    "record_rank_leg",
)


@query(
    "race_table",
    wide_sql(
        "season, race_number, course, is_champ, date_ymd, name, athlete_link, place_overall, "
        "effort_rank_overall, total_overall_hms, overall_valid, season_pb_overall, record_rank_overall",
        RACE_VALUES,
    ),
)
def race_table(spark, sf_dir):
    return reports.race_table(saved_facts(spark, sf_dir))


@query(
    "participants_table",
    facts_sql(
        """SELECT season, race_number, course, is_champ, name_last, athlete_link FROM facts
        WHERE part = 'Swim'"""
    ),
)
def participants_table(spark, sf_dir):
    return reports.participants_table(saved_facts(spark, sf_dir))


RECORD_KEYS = (
    "season, course, record_rank_overall, name, athlete_link, total_overall_hms, race_link, race_number, "
    "is_champ, overall_valid, season_pb_overall"
)


@query(
    "record_table_overall",
    wide_sql(RECORD_KEYS, reports.RECORD_VALUES, "season_pb_overall"),
)
def record_table_overall(spark, sf_dir):
    return reports.record_table_overall(saved_facts(spark, sf_dir))


def _record_leg(leg: str) -> None:
    text = wide_sql(
        RECORD_KEYS,
        reports.RECORD_VALUES,
        "effort_has_pb",
        f"max(CASE WHEN part = '{leg}' THEN season_pb_leg END)",
    )

    @query(f"record_table_leg_{leg.lower()}", text)
    def record_table_leg(spark, sf_dir):
        return reports.record_table_leg(saved_facts(spark, sf_dir), leg)


for _leg in LEGS:
    _record_leg(_leg)


@query(
    "athlete_course_table",
    wide_sql(
        "name, season, course, effort_rank_overall, total_overall_hms, race_link, race_number, is_champ, "
        "overall_valid, season_pb_overall, record_rank_overall",
        ("duration_hms", "effort_rank_leg", "season_pb_leg", "split_valid", "record_rank_leg"),
    ),
)
def athlete_course_table(spark, sf_dir):
    return reports.athlete_course_table(saved_facts(spark, sf_dir))


@query(
    "athlete_table",
    wide_sql(
        "name, season, race_link, date_ymd, course, course_nice, is_champ, total_overall_hms, overall_valid, "
        "season_pb_overall, record_rank_overall",
        ("duration_hms", "season_pb_leg", "split_valid", "record_rank_leg"),
    ),
)
def athlete_table(spark, sf_dir):
    return reports.athlete_table(saved_facts(spark, sf_dir))


@query(
    "season_leaderboard",
    facts_sql(
        """SELECT season, name, entries_total, entries_total_fd, name_last, athlete_link,
        CAST(rank() OVER (PARTITION BY season ORDER BY entries_total DESC) AS INTEGER) AS entries_total_rank
        FROM (SELECT DISTINCT season, name, entries_total, entries_total_fd, name_last, athlete_link
          FROM facts WHERE is_last_entry AND part = 'Swim')"""
    ),
)
def season_leaderboard(spark, sf_dir):
    return reports.season_leaderboard(saved_facts(spark, sf_dir))


@query(
    "career_leaderboard",
    facts_sql(
        """SELECT name, entries_total_all, entries_total_all_fd, name_last, athlete_link,
        CAST(rank() OVER (ORDER BY entries_total_all DESC NULLS LAST) AS INTEGER) AS entries_total_all_rank
        FROM (SELECT DISTINCT name, entries_total_all, entries_total_all_fd, name_last, athlete_link
          FROM facts WHERE is_last_entry_all AND part = 'Swim')"""
    ),
)
def career_leaderboard(spark, sf_dir):
    return reports.career_leaderboard(saved_facts(spark, sf_dir))


@query("career_table", careers_sql("SELECT * FROM careers"))
def career_table(spark, sf_dir):
    return reports.career_table(careers(spark, sf_dir))


@query(
    "career_table_milestones",
    careers_sql(
        """SELECT *, CAST(10 - entries_fd % 10 AS INTEGER) AS milestone_distance FROM careers
        WHERE 10 - entries_fd % 10 <= 3"""
    ),
)
def career_table_milestones(spark, sf_dir):
    return reports.career_table(careers(spark, sf_dir), milestone=True, every=10)


@query(
    "entries_over_time",
    facts_sql(
        """SELECT season, race_number, name, name_last, entries_cumulative, name || chr(10) || 'Race #: '
        || race_number || chr(10) || 'Date: ' || strftime(date_ymd, '%Y-%m-%d') || chr(10)
        || 'Entries so far: ' || entries_cumulative AS tooltip FROM facts WHERE part = 'Swim'"""
    ),
)
def entries_over_time(spark, sf_dir):
    return reports.entries_over_time(saved_facts(spark, sf_dir))


@query(
    "athlete_index",
    """SELECT CASE WHEN p_type = '' THEN 'Unknown' ELSE substr(replace(name, 'X ', ''), 1, 1) END AS initial,
      name, replace(name, 'X ', '') AS name_last, 'X' AS name_first,
      '[' || name || '](#a-' || replace(lower(name), ' ', '-') || ')' AS link
    FROM (SELECT DISTINCT 'X ' || p_name AS name, 'x' AS p_type FROM part)""",
)
def athlete_index(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("X "), "p_name").alias("name"))
    return reports.athlete_index(split_names(parts))


@query(
    "athlete_headline",
    careers_sql(
        """SELECT name, entries, 'Entrant has ' || entries || CASE WHEN entries = 1 THEN ' entry.'
        ELSE ' entries.' END AS sentence FROM careers WHERE name IN (SELECT name FROM efforts)"""
    ),
)
def athlete_headline(spark, sf_dir):
    rows = split_names(efforts(spark, sf_dir))
    return reports.athlete_headline(rows, careers(spark, sf_dir))


@query(
    "season_best_export",
    facts_sql(
        f"""SELECT season, course, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(bib AS INTEGER) END
          AS bib, facts.name, {hms_sql("overall_seconds")} AS best_time_hms
        FROM facts LEFT JOIN customer ON c_custkey = CAST(bib AS BIGINT)
        WHERE season_pb_overall AND part = 'Swim'"""
    ),
)
def season_best_export(spark, sf_dir):
    """Customers of one segment hand their bib back."""
    given_back = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .select(
            F.concat(F.lit("Entrant K"), F.col("c_custkey").cast("string")).alias("name"),
            F.lit(None).cast("int").alias("bib"),
        )
    )
    return reports.season_best_export(saved_facts(spark, sf_dir), overrides=given_back)


@query(
    "team_table",
    """SELECT season, race_number, team_number,
      max(CASE WHEN slot = 0 THEN link END) AS racer_1, max(CASE WHEN slot = 1 THEN link END) AS racer_2,
      max(CASE WHEN slot = 2 THEN link END) AS racer_3
    FROM (SELECT '2020-2021' AS season, CAST(c_nationkey AS INTEGER) AS race_number,
        CAST(c_custkey // 3 AS VARCHAR) AS team_number, c_custkey % 3 AS slot,
        '<a href="a-' || replace(lower(c_name), ' ', '-') || '.html#a-' || replace(lower(c_name), ' ', '-')
          || '">' || c_name || '</a>' AS link FROM customer)
    GROUP BY 1, 2, 3""",
)
def team_table(spark, sf_dir):
    """Three customers in a row are a team, raced once per nation."""
    rows = table(spark, sf_dir, "customer").select(
        F.lit("2020-2021").alias("season"),
        F.col("c_nationkey").alias("race_number"),
        F.floor(F.col("c_custkey") / 3).cast("string").alias("team_number"),
        F.concat(F.lit("Racer "), (F.col("c_custkey") % 3 + 1).cast("string")).alias("racer_ref"),
        F.col("c_name").alias("name"),
        F.lit("teams").alias("course"),
        F.lit(True).alias("started"),
        F.lit("Swim").alias("part"),
    )
    return reports.team_table(split_names(rows))


# chart rows --------------------------------------------------------------------------------------

LEG_LINE = """|| CASE WHEN split_valid AND NOT cumulative_valid THEN ' (valid)' ELSE '' END || ': '
  || duration_hms_short"""
SUM_LINE = """'Cumulative' || CASE WHEN cumulative_valid THEN '' ELSE ' (invalid)' END
  || CASE WHEN cumulative_valid AND NOT split_valid THEN ' (valid)' ELSE '' END || ': '
  || cumulative_hms_short"""
PLACE_NAME = "CASE WHEN overall_valid THEN CAST(place_overall AS VARCHAR) ELSE 'TBC' END || ' ' || name"


@query(
    "race_bars",
    facts_sql(
        f"""SELECT season, race_number, course, is_champ, name, part, display_class, duration_mins,
        place_overall, {PLACE_NAME} AS place_name,
        name || CASE WHEN first_race AND race_number <> 1 THEN ' - First race this season' ELSE '' END
        || chr(10) || display_class {LEG_LINE}
        || CASE WHEN split_valid THEN ' (' || place_leg_nice || ')' ELSE '' END
        || CASE WHEN new_pb_leg AND NOT season_pb_leg THEN ' New PB!' ELSE '' END
        || CASE WHEN season_pb_leg THEN CASE WHEN record_rank_leg = 1 THEN ' Season record!'
             ELSE ' Season PB!' END ELSE '' END || chr(10) || {SUM_LINE}
        || CASE WHEN cumulative_valid THEN ' (' || place_cumulative_nice || ')' ELSE '' END
        || CASE WHEN new_pb_cumulative THEN ' New PB!' ELSE '' END AS tooltip FROM facts"""
    ),
)
def race_bars(spark, sf_dir):
    return charts.race_bars(saved_facts(spark, sf_dir))


@query(
    "record_bars",
    facts_sql(
        f"""SELECT season, course, race_number, is_champ, name, part, display_class, duration_mins,
        record_rank_overall, record_rank_overall || ' ' || name AS place_name,
        name || chr(10) || 'Race #: ' || race_number || chr(10) || 'Date: ' || race_link || chr(10)
        || display_class {LEG_LINE} || CASE WHEN season_pb_leg THEN ' PB!' ELSE '' END
        || CASE WHEN record_rank_leg = 1 THEN ' Season record!' ELSE '' END || chr(10) || {SUM_LINE}
        AS tooltip FROM facts WHERE season_pb_overall"""
    ),
)
def record_bars(spark, sf_dir):
    return charts.record_bars(saved_facts(spark, sf_dir))


@query(
    "athlete_bars",
    facts_sql(
        f"""SELECT name, season, race_number, is_champ, course, part, display_class_pb, duration_mins,
        plot_label, CASE WHEN plot_label IS NOT NULL THEN overall_mins END AS label_height,
        {PLACE_NAME} AS place_name,
        'Race #: ' || race_number || chr(10) || 'Date: ' || race_link || chr(10) || 'Course: '
        || course_nice || chr(10) || CASE WHEN course = 'teams' THEN 'No timing available' ELSE
          display_class_pb {LEG_LINE}
          || CASE WHEN new_pb_leg AND NOT season_pb_leg THEN ' New PB!' ELSE '' END
          || CASE WHEN season_pb_leg THEN ' Season PB!' ELSE '' END
          || CASE WHEN record_rank_leg = 1 THEN ' Season record!' ELSE '' END || chr(10) || {SUM_LINE}
          || CASE WHEN new_pb_cumulative THEN ' New PB!' ELSE '' END END AS tooltip
        FROM (SELECT *, CASE WHEN part = 'Run' THEN CASE course WHEN 'double' THEN 'D' WHEN 'int' THEN 'I'
          WHEN 'teams' THEN 'T' END END AS plot_label FROM facts)"""
    ),
)
def athlete_bars(spark, sf_dir):
    return charts.athlete_bars(saved_facts(spark, sf_dir))


# replay ------------------------------------------------------------------------------------------

REPLAY_SQL = """
rows0 AS (SELECT season, race_number, course, is_champ, date_ymd, name, part, leg, display_class,
    cumulative_mins AS mins, place_cumulative AS pl,
    CAST(row_number() OVER (PARTITION BY season, race_number, course, is_champ, part
      ORDER BY name_last, name_first, name) AS INTEGER) AS alpha FROM facts),
framed AS (SELECT a.season, a.race_number, a.course, a.is_champ, a.date_ymd, a.name, a.part,
    CAST(s.stage AS INTEGER) AS stage, a.display_class,
    CASE WHEN bars = 0 THEN 0.0 ELSE w.mins END AS width,
    CASE WHEN ordered = 0 THEN a.alpha ELSE p.pl END AS place
  FROM rows0 a, (VALUES (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 2, 1), (5, 2, 2), (6, 3, 2), (7, 3, 3))
    s(stage, bars, ordered)
  LEFT JOIN rows0 w ON w.name = a.name AND w.date_ymd = a.date_ymd AND w.course = a.course
    AND w.is_champ = a.is_champ AND w.leg = least(a.leg, bars)
  LEFT JOIN rows0 p ON p.name = a.name AND p.date_ymd = a.date_ymd AND p.course = a.course
    AND p.is_champ = a.is_champ AND p.leg = ordered),
moved AS (SELECT *, CASE WHEN stage >= 4 THEN place - lag(place, 2) OVER (
  PARTITION BY season, race_number, course, is_champ, date_ymd, name, part ORDER BY stage) END
  AS place_diff FROM framed)"""


@query(
    "race_replay",
    facts_sql(
        """SELECT *,
        CASE WHEN stage IN (5, 7) THEN CASE WHEN place_diff < 0 THEN 'up' WHEN place_diff > 0 THEN 'down'
          WHEN place_diff = 0 THEN 'equal' END END AS change_type,
        CASE WHEN stage IN (5, 7) THEN CASE WHEN place_diff < 0 THEN '↑ ' || (-place_diff)
          WHEN place_diff > 0 THEN '↓ ' || place_diff WHEN place_diff = 0 THEN '-' END END AS change_text
        FROM (SELECT season, race_number, course, is_champ, date_ymd, name, part, stage, display_class,
          CAST(width AS DOUBLE) AS width, place, place_diff FROM moved)""",
        REPLAY_SQL,
    ),
)
def race_replay(spark, sf_dir):
    return replay.race_replay(saved_facts(spark, sf_dir))


@query(
    "participation_replay",
    sql(
        """SELECT told.season, CAST(stage AS INTEGER) AS stage, race_number,
          CAST(CASE WHEN race_number > stage THEN 0 ELSE entries END AS BIGINT) AS entries,
          CAST(CASE WHEN race_number <= stage THEN entries_label END AS BIGINT) AS entries_label,
          CASE WHEN race_number <= stage THEN reason_sign END AS reason_sign,
          CAST(6 - 3 * (race_number % 2) AS INTEGER) AS sign_height,
          CASE WHEN race_number = stage THEN summary_text END AS summary_text
        FROM told JOIN (SELECT season, max(CASE WHEN have_results THEN race_number END) AS last
          FROM told GROUP BY 1) l ON l.season = told.season, range(0, 367) t(stage) WHERE stage <= last""",
        EFFORTS_SQL,
        FIRST_SQL,
        CALENDAR_SQL,
        PROGRESS_SQL,
    ),
)
def participation_replay(spark, sf_dir):
    return replay.participation_replay(progress(spark, sf_dir))
