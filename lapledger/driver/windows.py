"""Places, ranks, running totals and bests on orders; effort steps on orders with their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapledger.driver import views
from lapledger.driver.registry import query
from lapledger.driver.views import (
    EFFORTS_SQL,
    WIDE_SQL,
    efforts,
    facts,
    facts_sql,
    hms_sql,
    long_rows,
    sql,
    table,
    timed_sql,
    wide_seconds,
)
from lapledger.functions.times import time_seconds
from lapledger.model import LEGS
from lapledger.operators import bests, ranks, reconcile, totals, update
from lapledger.operators.clean import clean_names, parse_times
from lapledger.plans import snapshot
from lapledger.plans.facts import cleaned_results, labelled_results
from lapledger.session import new_path, remove, settle, settled_for_now

KEYS = ["name", "date_ymd", "effort"]
TIES = {"tie_keys": ("name", "date_ymd", "effort")}
RACE = ("season", "race_number", "course")
OWN = ("name", "season", "course")
ORDER = ("date_ymd", "effort")


def leg_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per effort and leg with minutes, running minutes and flags."""
    wide = wide_seconds(spark, sf_dir)
    d = [F.coalesce(f"s{i}", F.lit(0.0)) for i in (1, 2, 3)]
    cumulative = [d[0], d[0] + d[1], d[0] + d[1] + d[2]]
    legs = F.array(
        *[
            F.struct(
                F.lit(leg).alias("part"),
                (d[i] / 60).alias("duration_mins"),
                (cumulative[i] / 60).alias("cumulative_mins"),
                (~F.col(f"r{i + 1}")).alias("split_valid"),
                (~F.col("end_bad") if i == 2 else F.lit(True)).alias("cumulative_valid"),
            )
            for i, leg in enumerate(LEGS)
        ]
    )
    return wide.select(
        "name",
        "season",
        "race_number",
        "date_ymd",
        "course",
        "is_champ",
        F.lit(True).alias("started"),
        F.inline(legs),
    )


LEG_TIMES_SQL = """
leg_times AS (
  SELECT name, season, race_number, date_ymd, course, is_champ, p.part,
    CASE p.leg WHEN 1 THEN coalesce(s1, 0) WHEN 2 THEN coalesce(s2, 0) ELSE coalesce(s3, 0) END / 60
      AS duration_mins,
    CASE p.leg WHEN 1 THEN coalesce(s1, 0) WHEN 2 THEN coalesce(s1, 0) + coalesce(s2, 0)
      ELSE coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) END / 60 AS cumulative_mins,
    CASE p.leg WHEN 1 THEN NOT r1 WHEN 2 THEN NOT r2 ELSE NOT r3 END AS split_valid,
    p.leg <> 3 OR NOT end_bad AS cumulative_valid
  FROM wide, (VALUES ('Swim', 1), ('Ride', 2), ('Run', 3)) p(part, leg))"""


def legs_sql(select: str) -> str:
    return sql(select, WIDE_SQL, LEG_TIMES_SQL)


def rank_sql(name: str, partition: str, value: str, valid: str) -> str:
    return (
        f"CAST(row_number() OVER (PARTITION BY {partition} ORDER BY CASE WHEN {valid} THEN {value} END "
        f"NULLS LAST, name, date_ymd, part) AS INTEGER) AS {name}"
    )


LEG_OUT = ["name", "date_ymd", "part"]
RACE_SQL = "season, race_number, course, part, is_champ"
OWN_SQL = "name, season, course, part"


@query(
    "place_leg",
    legs_sql(
        "SELECT name, date_ymd, part, "
        + rank_sql("place_leg", RACE_SQL, "duration_mins", "split_valid")
        + " FROM leg_times"
    ),
)
def place_leg(spark, sf_dir):
    return ranks.place_leg(leg_times(spark, sf_dir)).select(*LEG_OUT, "place_leg")


@query(
    "place_cumulative",
    legs_sql(
        "SELECT name, date_ymd, part, "
        + rank_sql("place_cumulative", RACE_SQL, "cumulative_mins", "cumulative_valid")
        + " FROM leg_times"
    ),
)
def place_cumulative(spark, sf_dir):
    return ranks.place_cumulative(leg_times(spark, sf_dir)).select(*LEG_OUT, "place_cumulative")


@query(
    "effort_rank_leg",
    legs_sql(
        "SELECT name, date_ymd, part, "
        + rank_sql("effort_rank_leg", OWN_SQL, "duration_mins", "split_valid")
        + " FROM leg_times"
    ),
)
def effort_rank_leg(spark, sf_dir):
    return ranks.effort_rank_leg(leg_times(spark, sf_dir)).select(*LEG_OUT, "effort_rank_leg")


@query(
    "effort_rank_cumulative",
    legs_sql(
        "SELECT name, date_ymd, part, "
        + rank_sql("effort_rank_cumulative", OWN_SQL, "cumulative_mins", "cumulative_valid")
        + " FROM leg_times"
    ),
)
def effort_rank_cumulative(spark, sf_dir):
    ranked = ranks.effort_rank_cumulative(leg_times(spark, sf_dir))
    return ranked.select(*LEG_OUT, "effort_rank_cumulative")


def effort_place_sql(name: str, partition: str) -> str:
    return sql(
        f"""SELECT name, date_ymd, effort, CAST(row_number() OVER (PARTITION BY {partition}
        ORDER BY CASE WHEN overall_valid THEN overall_mins END NULLS LAST, name, date_ymd, effort)
        AS INTEGER) AS {name} FROM efforts""",
        EFFORTS_SQL,
    )


@query("place_overall", effort_place_sql("place_overall", "season, race_number, course"))
def place_overall(spark, sf_dir):
    return ranks.place_overall(efforts(spark, sf_dir), RACE, **TIES).select(*KEYS, "place_overall")


@query("effort_rank_overall", effort_place_sql("effort_rank_overall", "name, season, course"))
def effort_rank_overall(spark, sf_dir):
    ranked = ranks.effort_rank_overall(efforts(spark, sf_dir), OWN, **TIES)
    return ranked.select(*KEYS, "effort_rank_overall")


@query(
    "leaderboard_rank",
    sql(
        """SELECT season, name, entries, CAST(rank() OVER (PARTITION BY season ORDER BY entries DESC)
        AS INTEGER) AS total_rank
        FROM (SELECT season, name, count(*) AS entries FROM efforts GROUP BY 1, 2)""",
        EFFORTS_SQL,
    ),
)
def leaderboard_rank(spark, sf_dir):
    entries = efforts(spark, sf_dir).groupBy("season", "name").agg(F.count("*").alias("entries"))
    return ranks.leaderboard_rank(entries, ["season"], "entries")


@query(
    "leaderboard_rank_fd",
    facts_sql(
        """SELECT season, name, part, date_ymd, course, is_champ, entries_total_fd, entries_total_all_fd,
          CAST(rank() OVER (PARTITION BY season, part ORDER BY entries_total_fd DESC NULLS LAST) AS INTEGER)
            AS entries_total_fd_rank,
          CAST(rank() OVER (PARTITION BY part ORDER BY entries_total_all_fd DESC NULLS LAST) AS INTEGER)
            AS entries_total_all_fd_rank
        FROM facts WHERE is_last_entry""",
    ),
)
def leaderboard_rank_fd(spark, sf_dir):
    """Ranks of the full-and-double totals among the last entries of all seasons."""
    last = settle(facts(spark, sf_dir, until="counts").filter("is_last_entry").select(
        "season", "name", "part", "date_ymd", "course", "is_champ", "entries_total_fd", "entries_total_all_fd"
    ))
    ranked = ranks.leaderboard_rank(last, ["season", "part"], "entries_total_fd", "entries_total_fd_rank")
    return ranks.leaderboard_rank(ranked, ["part"], "entries_total_all_fd", "entries_total_all_fd_rank", hot=True)


@query(
    "record_rank_overall",
    sql(
        """SELECT name, date_ymd, effort, CASE WHEN pb THEN CAST(row_number() OVER (
          PARTITION BY course, season, pb ORDER BY overall_mins, name, date_ymd, effort) AS INTEGER) END
          AS record_rank_overall
        FROM (SELECT *, coalesce(overall_valid AND overall_mins = min(CASE WHEN overall_valid
          THEN overall_mins END) OVER (PARTITION BY name, season, course), false) AS pb FROM efforts)""",
        EFFORTS_SQL,
    ),
)
def record_rank_overall(spark, sf_dir):
    bested = bests.season_pb(
        efforts(spark, sf_dir), {"season_pb_overall": bests.MEASURES["overall"]}, OWN
    )
    ranked = ranks.record_rank_overall(bested, ("course", "season"), **TIES)
    return ranked.select(*KEYS, "record_rank_overall")


@query(
    "record_rank_leg",
    legs_sql(
        """SELECT name, date_ymd, part, CASE WHEN pb THEN CAST(row_number() OVER (
          PARTITION BY course, season, part, pb ORDER BY duration_mins, name, date_ymd, part) AS INTEGER)
          END AS record_rank_leg
        FROM (SELECT *, coalesce(split_valid AND duration_mins = min(CASE WHEN split_valid
          THEN duration_mins END) OVER (PARTITION BY name, season, course, part), false) AS pb
          FROM leg_times)"""
    ),
)
def record_rank_leg(spark, sf_dir):
    bested = bests.season_pb(
        leg_times(spark, sf_dir), {"season_pb_leg": bests.MEASURES["leg"]}
    )
    return ranks.record_rank_leg(bested).select(*LEG_OUT, "record_rank_leg")


@query(
    "alphabetic_place",
    sql(
        """SELECT name, date_ymd, effort, CAST(row_number() OVER (PARTITION BY season, race_number, course
        ORDER BY substr(name, 9), 'Entrant', name, effort) AS INTEGER) AS alphabetic_place FROM efforts""",
        EFFORTS_SQL,
    ),
)
def alphabetic_place(spark, sf_dir):
    named = clean_names(efforts(spark, sf_dir))
    order = ("name_last", "name_first", "name", "effort")
    placed = ranks.alphabetic_place(named, RACE, order=order)
    return placed.select(*KEYS, "alphabetic_place")


@query(
    "place_change",
    """WITH daily AS (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
    staged AS (
      SELECT user_id, day, CAST(row_number() OVER (PARTITION BY day ORDER BY n DESC, user_id) AS INTEGER)
        AS place, CAST(day(day) AS INTEGER) AS stage FROM daily),
    moved AS (
      SELECT *, CASE WHEN stage >= 4 THEN place - lag(place, 2) OVER (
        PARTITION BY user_id ORDER BY stage) END AS place_diff FROM staged)
    SELECT user_id, stage, place, place_diff,
      CASE WHEN stage IN (5, 7) THEN CASE WHEN place_diff < 0 THEN 'up' WHEN place_diff > 0 THEN 'down'
        WHEN place_diff = 0 THEN 'equal' END END AS change_type,
      CASE WHEN stage IN (5, 7) THEN CASE WHEN place_diff < 0 THEN '↑ ' || (-place_diff)
        WHEN place_diff > 0 THEN '↓ ' || place_diff WHEN place_diff = 0 THEN '-' END END AS change_text
    FROM moved""",
)
def place_change(spark, sf_dir):
    """Users ranked by events per day; the days are the stages."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"))
        .withColumns({"rank_by": -F.col("n"), "counts": F.lit(True)})
    )
    placed = ranks.place(daily, "place", "rank_by", "counts", ["day"], ["user_id"])
    staged = placed.withColumn("stage", F.dayofmonth("day"))
    return ranks.place_change(staged, ["user_id"]).select(
        "user_id", "stage", "place", "place_diff", "change_type", "change_text"
    )


# running entries ---------------------------------------------------------------------------------


def entries_sql(select: str) -> str:
    return sql(f"SELECT name, date_ymd, effort, {select} FROM efforts", EFFORTS_SQL)


SEASON_WINDOW = "(PARTITION BY name, season ORDER BY date_ymd, effort ROWS UNBOUNDED PRECEDING)"
CAREER_WINDOW = "(PARTITION BY name ORDER BY date_ymd, effort ROWS UNBOUNDED PRECEDING)"
FD = "CASE WHEN course IN ('full', 'double') THEN 1 END"


@query(
    "running_entries",
    entries_sql(f"CAST(count(*) OVER {SEASON_WINDOW} AS BIGINT) AS entries_cumulative"),
)
def running_entries(spark, sf_dir):
    counted = totals.running_entries(efforts(spark, sf_dir), totals.SEASON, ORDER)
    return counted.select(*KEYS, "entries_cumulative")


@query(
    "running_entries_fd",
    entries_sql(f"CAST(count({FD}) OVER {SEASON_WINDOW} AS BIGINT) AS entries_cumulative_fd"),
)
def running_entries_fd(spark, sf_dir):
    counted = totals.running_entries_fd(efforts(spark, sf_dir), totals.SEASON, ORDER)
    return counted.select(*KEYS, "entries_cumulative_fd")


@query(
    "season_totals",
    entries_sql("CAST(count(*) OVER (PARTITION BY name, season) AS BIGINT) AS entries_total"),
)
def season_totals(spark, sf_dir):
    counted = totals.running_entries(efforts(spark, sf_dir), totals.SEASON, ORDER)
    return totals.season_totals(counted).select(*KEYS, "entries_total")


@query(
    "last_entry",
    entries_sql("race_number = max(race_number) OVER (PARTITION BY name, season) AS is_last_entry"),
)
def last_entry(spark, sf_dir):
    return totals.last_entry(efforts(spark, sf_dir)).select(*KEYS, "is_last_entry")


@query(
    "last_entry_all",
    entries_sql("date_ymd = max(date_ymd) OVER (PARTITION BY name) AS is_last_entry_all"),
)
def last_entry_all(spark, sf_dir):
    marked = totals.last_entry(efforts(spark, sf_dir), ["name"], "date_ymd", "is_last_entry_all")
    return marked.select(*KEYS, "is_last_entry_all")


def with_before(spark, sf_dir):
    """Entries before the counted seasons: the customer's orders until 1997, as a separate table."""
    rows = efforts(spark, sf_dir)
    old = rows.filter(F.col("season") < "1998-1999").groupBy("name").agg(
        F.count("*").alias("entries_before")
    )
    return rows.filter(F.col("season") >= "1998-1999").join(old, "name", "left")


def career_sql(select: str) -> str:
    return sql(
        f"SELECT name, date_ymd, effort, {select} FROM recent LEFT JOIN old USING (name)",
        EFFORTS_SQL,
        """
old AS (SELECT name, count(*) AS before FROM efforts WHERE season < '1998-1999' GROUP BY 1),
recent AS (SELECT * FROM efforts WHERE season >= '1998-1999')""",
    )


@query(
    "career_entries",
    career_sql(f"CAST(count(*) OVER {CAREER_WINDOW} AS BIGINT) + before AS entries_cumulative_all"),
)
def career_entries(spark, sf_dir):
    counted = totals.career_entries(with_before(spark, sf_dir), ["name"], ORDER)
    return counted.select(*KEYS, "entries_cumulative_all")


@query(
    "career_entries_legacy",
    career_sql(
        f"CAST(sum(1 + before) OVER {CAREER_WINDOW} AS BIGINT) AS entries_cumulative_all"
    ),
)
def career_entries_legacy(spark, sf_dir):
    counted = totals.career_entries(with_before(spark, sf_dir), ["name"], ORDER, legacy=True)
    return counted.select(*KEYS, "entries_cumulative_all")


@query(
    "career_entries_fd",
    career_sql(
        f"CAST(count({FD}) OVER {CAREER_WINDOW} AS BIGINT) + before AS entries_cumulative_all_fd"
    ),
)
def career_entries_fd(spark, sf_dir):
    counted = totals.career_entries_fd(with_before(spark, sf_dir), ["name"], ORDER)
    return counted.select(*KEYS, "entries_cumulative_all_fd")


@query("first_race", entries_sql(f"count(*) OVER {SEASON_WINDOW} = 1 AS first_race"))
def first_race(spark, sf_dir):
    counted = totals.running_entries(efforts(spark, sf_dir), totals.SEASON, ORDER)
    return totals.first_race(counted).select(*KEYS, "first_race")


# bests -------------------------------------------------------------------------------------------

OWN_SO_FAR = "(PARTITION BY name, season, course ORDER BY date_ymd, effort ROWS UNBOUNDED PRECEDING)"
LEG_SO_FAR = "(PARTITION BY name, season, course, part ORDER BY date_ymd ROWS UNBOUNDED PRECEDING)"


def best_sql(measure: str, value: str, valid: str) -> str:
    return legs_sql(
        f"""SELECT name, date_ymd, part, CASE WHEN {valid} THEN min(CASE WHEN {valid} THEN {value} END)
        OVER {LEG_SO_FAR} END AS running_best_{measure} FROM leg_times"""
    )


def new_pb_sql(measure: str, value: str, valid: str) -> str:
    return legs_sql(
        f"""SELECT name, date_ymd, part, coalesce({valid} AND {value} = min(CASE WHEN {valid}
        THEN {value} END) OVER {LEG_SO_FAR} AND count(*) OVER (PARTITION BY name, season, part
        ORDER BY date_ymd ROWS UNBOUNDED PRECEDING) <> 1, false) AS new_pb_{measure} FROM leg_times"""
    )


def season_pb_sql(measure: str, value: str, valid: str) -> str:
    return legs_sql(
        f"""SELECT name, date_ymd, part, coalesce({valid} AND {value} = min(CASE WHEN {valid}
        THEN {value} END) OVER (PARTITION BY name, season, course, part), false)
        AS season_pb_{measure} FROM leg_times"""
    )


BEST_ORDER = ("date_ymd",)


@query("running_best_leg", best_sql("leg", "duration_mins", "split_valid"))
def running_best_leg(spark, sf_dir):
    best = bests.running_best_leg(leg_times(spark, sf_dir), order=BEST_ORDER)
    return best.select(*LEG_OUT, "running_best_leg")


@query("running_best_cumulative", best_sql("cumulative", "cumulative_mins", "cumulative_valid"))
def running_best_cumulative(spark, sf_dir):
    best = bests.running_best_cumulative(leg_times(spark, sf_dir), order=BEST_ORDER)
    return best.select(*LEG_OUT, "running_best_cumulative")


@query(
    "running_best_overall",
    sql(
        f"""SELECT name, date_ymd, effort, CASE WHEN overall_valid THEN min(CASE WHEN overall_valid
        THEN overall_mins END) OVER {OWN_SO_FAR} END AS running_best_overall FROM efforts""",
        EFFORTS_SQL,
    ),
)
def running_best_overall(spark, sf_dir):
    best = bests.running_best_overall(efforts(spark, sf_dir), partition=OWN, order=ORDER)
    return best.select(*KEYS, "running_best_overall")


def new_pb_query(measure: str):
    value, valid = bests.MEASURES[measure]

    def run(spark, sf_dir):
        rows = totals.first_race(
            totals.running_entries(leg_times(spark, sf_dir), order=BEST_ORDER)
        )
        best = f"running_best_{measure}"
        found = bests.running_best(rows, {best: (value, valid)}, order=BEST_ORDER)
        return bests.new_pb(found, f"new_pb_{measure}", value, best).select(
            *LEG_OUT, f"new_pb_{measure}"
        )

    return run


def season_pb_query(measure: str):
    name = f"season_pb_{measure}"

    def run(spark, sf_dir):
        rows = leg_times(spark, sf_dir)
        return bests.season_pb(rows, {name: bests.MEASURES[measure]}).select(*LEG_OUT, name)

    return run


for _measure in ("leg", "cumulative"):
    _columns = bests.MEASURES[_measure]
    query(f"new_pb_{_measure}", new_pb_sql(_measure, *_columns))(new_pb_query(_measure))
    query(f"season_pb_{_measure}", season_pb_sql(_measure, *_columns))(season_pb_query(_measure))


@query(
    "new_pb_overall",
    sql(
        f"""SELECT name, date_ymd, effort, coalesce(overall_valid AND overall_mins = min(CASE WHEN
        overall_valid THEN overall_mins END) OVER {OWN_SO_FAR} AND count(*) OVER {SEASON_WINDOW} <> 1,
        false) AS new_pb_overall FROM efforts""",
        EFFORTS_SQL,
    ),
)
def new_pb_overall(spark, sf_dir):
    rows = totals.running_entries(efforts(spark, sf_dir), totals.SEASON, ORDER)
    best = bests.running_best_overall(totals.first_race(rows), partition=OWN, order=ORDER)
    marked = bests.new_pb(best, "new_pb_overall", "overall_mins", "running_best_overall")
    return marked.select(*KEYS, "new_pb_overall")


@query(
    "season_pb_overall",
    sql(
        """SELECT name, date_ymd, effort, coalesce(overall_valid AND overall_mins = min(CASE WHEN
        overall_valid THEN overall_mins END) OVER (PARTITION BY name, season, course), false)
        AS season_pb_overall FROM efforts""",
        EFFORTS_SQL,
    ),
)
def season_pb_overall(spark, sf_dir):
    columns = {"season_pb_overall": bests.MEASURES["overall"]}
    return bests.season_pb(efforts(spark, sf_dir), columns, OWN).select(*KEYS, "season_pb_overall")


@query(
    "effort_has_pb",
    legs_sql(
        """SELECT name, date_ymd, part, bool_or(pb) OVER (PARTITION BY name, season, course, race_number)
        AS effort_has_pb
        FROM (SELECT *, coalesce(split_valid AND duration_mins = min(CASE WHEN split_valid
          THEN duration_mins END) OVER (PARTITION BY name, season, course, part), false) AS pb
          FROM leg_times)"""
    ),
)
def effort_has_pb(spark, sf_dir):
    bested = bests.season_pb(
        leg_times(spark, sf_dir), {"season_pb_leg": bests.MEASURES["leg"]}
    )
    return bests.effort_has_pb(bested).select(*LEG_OUT, "effort_has_pb")


@query(
    "display_class",
    facts_sql(
        """SELECT name, date_ymd, part, display_class, display_class_pb,
        CAST(list_position(['Swim', 'Ride', 'Run', 'Swim (PB)', 'Ride (PB)', 'Run (PB)', 'Swim (record)',
          'Ride (record)', 'Run (record)', 'Swim (invalid)', 'Ride (invalid)', 'Run (invalid)'],
          display_class_pb) AS INTEGER) AS display_order FROM facts"""
    ),
)
def display_class(spark, sf_dir):
    """The labels of the batch's places and records, from the columns that they read."""
    placed = facts(
        spark, sf_dir, until="places", columns=(*LEG_OUT, "split_valid", "season_pb_leg", "record_rank_leg")
    )
    return bests.display_class(placed).select(*LEG_OUT, "display_class", "display_class_pb", "display_order")


# effort steps ------------------------------------------------------------------------------------


def imported_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows with parsed seconds, before any correction."""
    rows = long_rows(spark, sf_dir).withColumns(
        {"duration_hms": F.col("duration_import"), "overall_hms": F.col("time_overall_import")}
    )
    parsed = parse_times(
        rows, {"duration_seconds": "duration_import", "overall_seconds": "time_overall_import"}
    )
    return clean_names(parsed, split=False).withColumn(
        "duration_seconds", F.coalesce("duration_seconds", F.lit(0.0))
    )


IMPORTED_SQL = """
imported AS (
  SELECT name, date_ymd, p.part, p.leg, status, end_bad, recorded, handicap_s, price,
    CASE p.leg WHEN 1 THEN coalesce(s1, 0) WHEN 2 THEN coalesce(s2, 0) ELSE coalesce(s3, 0) END AS d,
    coalesce(handicap_s + coalesce(s1, 0) > 0, false) AS handicap_valid,
    CASE p.leg WHEN 1 THEN coalesce(s1, 0) WHEN 2 THEN coalesce(s1, 0) + coalesce(s2, 0)
      ELSE coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) END AS c,
    coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) AS finish
  FROM wide, (VALUES ('Swim', 1), ('Ride', 2), ('Run', 3)) p(part, leg) WHERE started)"""


def imported_sql(select: str) -> str:
    return sql(select, WIDE_SQL, IMPORTED_SQL)


@query("cumulative_time", imported_sql("SELECT name, date_ymd, part, c AS cumulative_seconds FROM imported"))
def cumulative_time(spark, sf_dir):
    summed = reconcile.cumulative_time(imported_legs(spark, sf_dir))
    return summed.select(*LEG_OUT, "cumulative_seconds")


@query(
    "overall_validity",
    imported_sql("SELECT name, date_ymd, part, NOT end_bad AS overall_valid FROM imported"),
)
def overall_validity(spark, sf_dir):
    marked = reconcile.overall_validity(leg_times(spark, sf_dir))
    started = imported_legs(spark, sf_dir).select(*LEG_OUT)
    return started.join(marked.select(*LEG_OUT, "overall_valid"), LEG_OUT)


@query(
    "apply_handicap",
    imported_sql(
        f"""SELECT name, date_ymd, part, handicap_valid,
        CAST(CASE WHEN leg = 1 AND handicap_valid THEN d END AS DOUBLE) AS duration_seconds_original,
        CAST(d + CASE WHEN leg = 1 AND handicap_valid THEN handicap_s ELSE 0 END AS DOUBLE)
          AS duration_seconds,
        CAST(c + CASE WHEN handicap_valid THEN handicap_s ELSE 0 END AS DOUBLE) AS cumulative_seconds,
        CAST(CASE WHEN handicap_valid THEN finish + handicap_s ELSE recorded END AS DOUBLE)
          AS overall_seconds,
        CASE WHEN handicap_valid THEN {hms_sql("(finish + handicap_s)")} END AS overall_new
        FROM imported"""
    ),
)
def apply_handicap(spark, sf_dir):
    moved = reconcile.apply_handicap(imported_legs(spark, sf_dir))
    return moved.select(
        *LEG_OUT,
        "handicap_valid",
        "duration_seconds_original",
        "duration_seconds",
        "cumulative_seconds",
        "overall_seconds",
        F.when(F.col("handicap_valid"), F.col("overall_hms")).alias("overall_new"),
    )


RECONCILED_SQL = """
told AS (SELECT *, coalesce(abs(finish - recorded) > 1, false) AS disagree FROM imported)"""


@query(
    "reconcile_totals",
    sql(
        """SELECT name, date_ymd, part, disagree AS total_disagree,
        CASE WHEN disagree THEN CASE WHEN end_bad THEN 'imported' ELSE 'cumulative' END END
          AS total_resolve,
        CASE WHEN disagree THEN true END AS total_resolved,
        CAST(CASE WHEN disagree AND NOT end_bad THEN finish ELSE recorded END AS DOUBLE)
          AS overall_seconds,
        CAST(CASE WHEN disagree AND end_bad AND leg = 3 THEN recorded ELSE c END AS DOUBLE)
          AS cumulative_seconds
        FROM told""",
        WIDE_SQL,
        IMPORTED_SQL,
        RECONCILED_SQL,
    ),
)
def reconcile_totals(spark, sf_dir):
    flags = leg_times(spark, sf_dir).select(*LEG_OUT, "cumulative_valid")
    rows = reconcile.cumulative_time(imported_legs(spark, sf_dir)).join(flags, LEG_OUT)
    agreed = reconcile.reconcile_totals(rows)
    return agreed.select(
        *LEG_OUT,
        "total_disagree",
        "total_resolve",
        "total_resolved",
        "overall_seconds",
        "cumulative_seconds",
    )


@query(
    "fill_missing_overall",
    imported_sql(
        """SELECT name, date_ymd, part, CAST(coalesce(recorded, finish) AS DOUBLE) AS overall_seconds
        FROM imported"""
    ),
)
def fill_missing_overall(spark, sf_dir):
    summed = reconcile.cumulative_time(imported_legs(spark, sf_dir))
    return reconcile.fill_missing_overall(summed).select(*LEG_OUT, "overall_seconds")


@query(
    "final_cumulative",
    imported_sql(
        """SELECT name, date_ymd, part, CAST(CASE WHEN leg = 3 THEN recorded ELSE c END AS DOUBLE)
        AS cumulative_seconds FROM imported"""
    ),
)
def final_cumulative(spark, sf_dir):
    summed = reconcile.cumulative_time(imported_legs(spark, sf_dir))
    return reconcile.final_cumulative(summed).select(*LEG_OUT, "cumulative_seconds")


@query(
    "drop_cross_course_dupes",
    sql(
        """SELECT name, date_ymd, effort, course FROM (
          SELECT *, count(*) OVER (PARTITION BY name, part, date_ymd) AS n FROM efforts)
        WHERE NOT (n > 1 AND course = 'double')""",
        EFFORTS_SQL,
    ),
)
def drop_cross_course_dupes(spark, sf_dir):
    """Every date is listed, so any second order of a day drops the double course."""
    rows = efforts(spark, sf_dir)
    return reconcile.drop_cross_course_dupes(rows, rows.select("date_ymd")).select(*KEYS, "course")


@query(
    "batch_facts",
    facts_sql(
        """SELECT season, race_number, date_ymd, course, is_champ, name, part, entry_source, split_valid,
        cumulative_valid, overall_valid, duration_seconds, cumulative_seconds, overall_seconds,
        place_leg, place_cumulative, place_overall, effort_rank_leg, effort_rank_cumulative,
        effort_rank_overall, entries_cumulative, entries_total, entries_total_fd, is_last_entry,
        entries_cumulative_all, entries_cumulative_all_fd, entries_total_all, entries_total_all_fd,
        is_last_entry_all, first_race, new_pb_leg, new_pb_cumulative, new_pb_overall, season_pb_leg,
        season_pb_cumulative, season_pb_overall, record_rank_overall, record_rank_leg, effort_has_pb,
        duration_hms_short, cumulative_hms_short, place_leg_nice, place_cumulative_nice
        FROM facts"""
    ),
)
def batch_facts(spark, sf_dir):
    """The whole batch: raw texts to places, totals, bests and records."""
    return facts(spark, sf_dir).select(
        "season",
        "race_number",
        "date_ymd",
        "course",
        "is_champ",
        "name",
        "part",
        "entry_source",
        "split_valid",
        "cumulative_valid",
        "overall_valid",
        "duration_seconds",
        "cumulative_seconds",
        "overall_seconds",
        "place_leg",
        "place_cumulative",
        "place_overall",
        "effort_rank_leg",
        "effort_rank_cumulative",
        "effort_rank_overall",
        "entries_cumulative",
        "entries_total",
        "entries_total_fd",
        "is_last_entry",
        "entries_cumulative_all",
        "entries_cumulative_all_fd",
        "entries_total_all",
        "entries_total_all_fd",
        "is_last_entry_all",
        "first_race",
        "new_pb_leg",
        "new_pb_cumulative",
        "new_pb_overall",
        "season_pb_leg",
        "season_pb_cumulative",
        "season_pb_overall",
        "record_rank_overall",
        "record_rank_leg",
        "effort_has_pb",
        "duration_hms_short",
        "cumulative_hms_short",
        "place_leg_nice",
        "place_cumulative_nice",
    )


@query(
    "add_season",
    facts_sql(
        """SELECT season, race_number, date_ymd, course, is_champ, name, part, place_overall, record_rank_overall,
        entries_cumulative, entries_total, is_last_entry, entries_cumulative_all, entries_cumulative_all_fd,
        entries_total_all, entries_total_all_fd, is_last_entry_all FROM facts"""
    ),
)
def add_season(spark, sf_dir):
    """A snapshot of all seasons but the first and the last, to which these are added, the earlier one last."""
    path = new_path(spark, "seasons")
    with settled_for_now(spark):
        wide = settle(views.wide_seconds(spark, sf_dir))
        first, last = wide.agg(F.min("season"), F.max("season")).first()
        for part in (~F.col("season").isin(first, last), F.col("season") == last, F.col("season") == first):
            once = new_path(spark, "season")
            rows = facts(spark, sf_dir, wide.filter(part), until="places", into=once)
            snapshot.save_seasons(rows, path, settled=True)
            remove(spark, once)
    return labelled_results(snapshot.load_seasons(spark, path)).select(
        "season", "race_number", "date_ymd", "course", "is_champ", "name", "part", "place_overall", "record_rank_overall",
        "entries_cumulative", "entries_total", "is_last_entry", *snapshot.CAREER,
    )


@query(
    "timed_efforts",
    timed_sql(
        """SELECT name, date_ymd, part, handicap_valid, total_disagree, total_resolve, duration_seconds,
        cumulative_seconds, overall_seconds FROM timed"""
    ),
)
def timed_efforts(spark, sf_dir):
    """Only the effort steps of the batch."""
    timed = facts(spark, sf_dir, until="times").select(
        *LEG_OUT,
        "handicap_valid",
        "total_disagree",
        "total_resolve",
        "duration_seconds",
        "cumulative_seconds",
        "overall_seconds",
    )
    return settle(timed)


@query(
    "time_of_day_fix",
    sql(
        f"""SELECT name, date_ymd, part,
        CASE WHEN day(date_ymd) = 31 THEN regexp_replace(t, '^7', '1') ELSE t END AS time_overall_import,
        CASE WHEN day(date_ymd) = 31 AND leg = 1 THEN round(coalesce(
          CASE WHEN t LIKE '7%' THEN recorded - 6 * f END, recorded), 3) END AS first_leg_seconds
        FROM (SELECT *, CASE WHEN recorded IS NULL THEN 'DNF' ELSE
            CASE WHEN recorded < 3600 THEN regexp_replace(printf('%d:%02d.%d',
              CAST(floor(recorded / 60) AS BIGINT), CAST(floor(recorded) AS BIGINT) % 60,
              CAST(recorded * 10 AS BIGINT) % 10), '^0(\\d)', '\\1')
            ELSE printf('%d:%02d:%02d.%d', CAST(floor(recorded / 3600) AS BIGINT),
              CAST(floor(recorded / 60) AS BIGINT) % 60, CAST(floor(recorded) AS BIGINT) % 60,
              CAST(recorded * 10 AS BIGINT) % 10) END END AS t0,
            CASE WHEN recorded < 60 THEN '0:' || t0[3:] ELSE t0 END AS t,
            CASE WHEN recorded >= 3600 THEN 3600 WHEN recorded >= 600 THEN 600 ELSE 60 END AS f
          FROM imported)""",
        WIDE_SQL,
        IMPORTED_SQL,
    ),
)
def time_of_day_fix(spark, sf_dir):
    """Races on the last day of a long month recorded the clock."""
    rows = clean_names(long_rows(spark, sf_dir), split=False)
    fixed = update.time_of_day_fix(rows, views.bad_races(spark, sf_dir))
    listed = (F.dayofmonth("date_ymd") == 31) & (F.col("part") == "Swim")
    return fixed.select(
        *LEG_OUT,
        "time_overall_import",
        F.when(listed, time_seconds(F.col("duration_import"))).alias("first_leg_seconds"),
    )


@query(
    "invalidate",
    sql(
        """SELECT name, date_ymd, part,
        NOT lost AND NOT CASE leg WHEN 1 THEN r1 WHEN 2 THEN r2 ELSE r3 END AS split_valid,
        NOT lost AND NOT (leg = 3 AND end_bad) AS cumulative_valid
        FROM (SELECT *, race_type = 'Super Teams' OR day(date_ymd) = 31 AS lost FROM named WHERE started),
          (VALUES ('Swim', 1), ('Ride', 2), ('Run', 3)) p(part, leg)""",
        WIDE_SQL,
        """
named AS (
  SELECT wide.* EXCLUDE (name), 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING'
    THEN ' B' ELSE '' END AS name FROM wide LEFT JOIN customer ON c_custkey = o_custkey)""",
    ),
)
def invalidate(spark, sf_dir):
    rows = cleaned_results(
        long_rows(spark, sf_dir), views.aliases(spark, sf_dir), views.problems(spark, sf_dir)
    ).withColumn("overall_valid", F.lit(True))
    marked = update.invalidate(rows, views.bad_races(spark, sf_dir))
    return marked.select(*LEG_OUT, "split_valid", "cumulative_valid")
