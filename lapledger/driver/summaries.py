"""Summaries, checks, tracks and handicaps on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapledger import spread
from lapledger.driver.registry import query
from lapledger.driver.views import (
    BEFORE_SEASON,
    CALENDAR_SQL,
    EFFORTS_SQL,
    WIDE_SQL,
    aliases,
    efforts,
    history,
    newcomers,
    race_days,
    sql,
    table,
    wide_seconds,
)
from lapledger.driver.windows import LEG_TIMES_SQL, ORDER, leg_times
from lapledger.functions.names import first_name, last_name
from lapledger.operators import aggregates, bests, checks, geo, handicap, joins, totals
from lapledger.operators.calendar import course_labels

HISTORY_SQL = """
hist AS (
  SELECT name, year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS season, count(*) AS entries
  FROM (SELECT *, 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END
    AS name FROM orders LEFT JOIN customer ON c_custkey = o_custkey) GROUP BY 1, 2)"""

SEASONS_SQL = """
seasons AS (
  SELECT name, season, count(*) AS entries,
    count(CASE WHEN course IN ('full', 'double') THEN 1 END) AS entries_fd
  FROM efforts WHERE season >= '1998-1999' GROUP BY 1, 2
  UNION ALL SELECT name, season, entries, entries FROM hist WHERE season < '1998-1999')"""

CAREERS_SQL = """
careers AS (
  SELECT name, CAST(sum(entries_fd) AS BIGINT) AS entries_fd, CAST(sum(entries) AS BIGINT) AS entries,
    min(season) AS first_season, max(season) AS latest_season, count(*) AS season_count
  FROM seasons GROUP BY 1)"""


def careers_sql(select: str, *more: str) -> str:
    return sql(select, EFFORTS_SQL, HISTORY_SQL, SEASONS_SQL, CAREERS_SQL, *more)


def seasons(spark, sf_dir):
    """Seasons from 1998 on from the efforts, the ones before from the history."""
    recent = efforts(spark, sf_dir).filter(F.col("season") >= BEFORE_SEASON)
    return aggregates.season_summary(recent, history(spark, sf_dir), BEFORE_SEASON)


def careers(spark, sf_dir):
    return aggregates.career_summary(seasons(spark, sf_dir))


@query("season_summary", careers_sql("SELECT * FROM seasons"))
def season_summary(spark, sf_dir):
    return seasons(spark, sf_dir).filter(F.col("entries").isNotNull())


@query("career_summary", careers_sql("SELECT * FROM careers"))
def career_summary(spark, sf_dir):
    return careers(spark, sf_dir)


@query(
    "prehistory_totals",
    sql(
        """SELECT name, CAST(sum(entries) AS BIGINT) AS entries_before FROM hist
        WHERE season < '1998-1999' GROUP BY 1""",
        HISTORY_SQL,
    ),
)
def prehistory_totals(spark, sf_dir):
    return aggregates.prehistory_totals(history(spark, sf_dir), BEFORE_SEASON)


@query(
    "milestones",
    careers_sql(
        """SELECT *, CAST(5 - entries_fd % 5 AS INTEGER) AS milestone_distance FROM careers
        WHERE 5 - entries_fd % 5 <= 3"""
    ),
)
def milestones(spark, sf_dir):
    return aggregates.milestones(careers(spark, sf_dir), every=5)


def last_entries(spark, sf_dir):
    """One row per user with the number of active days."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"))
        .agg(F.count_distinct(F.to_date("ts")).alias("entries_total"))
        .withColumns({"name_first": first_name(F.col("name")), "name_last": last_name(F.col("name"))})
    )


LAST_SQL = """
last AS (SELECT 'User ' || user_id AS name, CAST(user_id AS VARCHAR) AS name_last,
  count(DISTINCT CAST(ts AS DATE)) AS entries_total FROM events GROUP BY 1, 2)"""


@query(
    "participation_histogram",
    sql(
        """SELECT entries_total, count(*) AS competitors, count(*) || ' entered ' || entries_total ||
        CASE WHEN entries_total = 1 THEN ' race' ELSE ' races' END || ':' || chr(10) AS tooltip_head
        FROM last GROUP BY entries_total""",
        LAST_SQL,
    ),
)
def participation_histogram(spark, sf_dir):
    return aggregates.participation_histogram(last_entries(spark, sf_dir))


@query(
    "participation_histogram_names",
    sql(
        """SELECT entries_total, n AS competitors, CAST(pos AS INTEGER) AS position, name, CASE
          WHEN pos = n THEN '' WHEN pos % (n // 20 + 1) = 0 THEN chr(10) ELSE ', ' END AS separator
        FROM (SELECT *, row_number() OVER (PARTITION BY entries_total ORDER BY name_last, name) AS pos,
          count(*) OVER (PARTITION BY entries_total) AS n FROM last)""",
        LAST_SQL,
    ),
)
def participation_histogram_names(spark, sf_dir):
    return aggregates.participation_histogram_names(last_entries(spark, sf_dir))


NICE_SQL = """CASE course WHEN 'int' THEN 'Intermediate' WHEN 'full' THEN 'Full' WHEN 'double'
  THEN 'Double Distance' ELSE 'Super Teams' END"""
PLACE_SQL = "CASE course WHEN 'int' THEN 1 WHEN 'full' THEN 2 WHEN 'double' THEN 3 ELSE 4 END"


@query(
    "entries_by_race_course",
    sql(
        f"""SELECT season, race_number, course_nice, course_order, entries, date_ymd,
          CAST(sum(entries) OVER (PARTITION BY season, race_number) AS BIGINT) AS entries_race,
          'Race #: ' || race_number || chr(10) || 'Date: ' || strftime(date_ymd, '%Y-%m-%d') || chr(10)
            || entries || ' entered the ' || course_nice || ' course' || chr(10)
            || CAST(sum(entries) OVER (PARTITION BY season, race_number) AS BIGINT)
            || ' entered all courses' AS tooltip
        FROM (SELECT season, race_number, {NICE_SQL} AS course_nice, CAST({PLACE_SQL} AS INTEGER)
          AS course_order, count(*) AS entries, min(date_ymd) AS date_ymd FROM efforts GROUP BY 1, 2, 3, 4)""",
        EFFORTS_SQL,
    ),
)
def entries_by_race_course(spark, sf_dir):
    return aggregates.entries_by_race_course(course_labels(efforts(spark, sf_dir)))


@query(
    "entries_by_course",
    sql(
        f"""SELECT season, {NICE_SQL} AS course_nice, CAST({PLACE_SQL} AS INTEGER) AS course_order,
        count(*) AS entries, count(*) || ' for ' || {NICE_SQL} AS fragment
        FROM efforts GROUP BY season, course""",
        EFFORTS_SQL,
    ),
)
def entries_by_course(spark, sf_dir):
    return aggregates.entries_by_course(course_labels(efforts(spark, sf_dir)))


@query(
    "season_headline",
    sql(
        """SELECT season, count(*) AS entries, count(DISTINCT name) AS competitors FROM efforts
        GROUP BY 1""",
        EFFORTS_SQL,
    ),
)
def season_headline(spark, sf_dir):
    return aggregates.season_headline(efforts(spark, sf_dir))


@query(
    "overall_headline",
    careers_sql(
        """SELECT CAST(sum(entries) AS BIGINT) AS entries, count(*) AS competitors,
        CAST((SELECT max(year(o_orderdate)) FROM orders) - 1989 + 1 AS INTEGER) AS seasons FROM careers"""
    ),
)
def overall_headline(spark, sf_dir):
    days = race_days(spark, sf_dir).withColumn("have_results", F.lit(True))
    return aggregates.overall_headline(careers(spark, sf_dir), days)


def counted_efforts(spark, sf_dir):
    counted = totals.running_entries(efforts(spark, sf_dir), totals.SEASON, ORDER)
    return totals.first_race(counted)


FIRST_SQL = """
firsts AS (SELECT *, row_number() OVER (PARTITION BY name, season ORDER BY date_ymd, effort) = 1
  AS first_race FROM efforts)"""

PROGRESS_SQL = """
entered AS (SELECT season, race_number, count(*) AS entries,
  count(CASE WHEN first_race THEN 1 END) AS first_timers FROM firsts GROUP BY 1, 2),
races AS (SELECT cal0.season, cal0.race_number, date_ymd, coalesce(cancelled, false) AS cancelled,
  coalesce(scheduled, true) AS scheduled, cancelled_reason, day(date_ymd) <= 29 AS have_results,
  CASE WHEN coalesce(cancelled, false) OR NOT coalesce(scheduled, true) THEN 0 ELSE entries END AS entries,
  CASE WHEN coalesce(cancelled, false) OR NOT coalesce(scheduled, true) THEN 0 ELSE first_timers END
    AS first_timers
  FROM cal0 LEFT JOIN entered ON cal0.season = entered.season AND cal0.race_number = entered.race_number),
progress AS (SELECT *,
  CAST(sum(coalesce(entries, 0)) OVER w AS BIGINT) AS entries_cumulative,
  CAST(sum(coalesce(first_timers, 0)) OVER w AS BIGINT) AS competitors_cumulative,
  CAST(count(CASE WHEN cancelled THEN 1 END) OVER w AS BIGINT) AS cancelled_cumulative,
  CASE WHEN have_results THEN entries END AS entries_label,
  CASE cancelled_reason WHEN 'COVID' THEN 'mask' WHEN 'XMAS' THEN 'christmas_tree' END AS reason_sign
  FROM races WINDOW w AS (PARTITION BY season ORDER BY race_number)),
told AS (SELECT *, 'As of Race ' || race_number || ' - ' || strftime(date_ymd, '%-d %b %Y') || chr(10)
  || 'Entries so far: ' || entries_cumulative || chr(10) || 'Competitors so far: '
  || competitors_cumulative || chr(10) || 'Cancelled Races so far: ' || cancelled_cumulative
  AS summary_text FROM progress)"""


def progress(spark, sf_dir):
    """Races up to the 29th of a month count as having results."""
    days = race_days(spark, sf_dir).withColumn("have_results", F.dayofmonth("date_ymd") <= 29)
    return aggregates.race_progress(counted_efforts(spark, sf_dir), days)


@query(
    "race_progress",
    sql(
        """SELECT season, race_number, date_ymd, cancelled, scheduled, have_results, cancelled_reason, entries,
        first_timers, entries_cumulative, competitors_cumulative, cancelled_cumulative, entries_label,
        reason_sign, summary_text FROM told""",
        EFFORTS_SQL,
        FIRST_SQL,
        CALENDAR_SQL,
        PROGRESS_SQL,
    ),
)
def race_progress(spark, sf_dir):
    return progress(spark, sf_dir)


@query(
    "race_headline",
    sql(
        """SELECT *, 'A total of ' || competitors || ' competitors entered' || CASE WHEN race_number <> 1
          AND first_timers > 0 THEN ', ' || first_timers || ' for the first time this season' ELSE '' END
          || '.' AS sentence
        FROM (SELECT season, race_number, count(*) AS competitors, count(CASE WHEN first_race THEN 1 END)
          AS first_timers FROM firsts GROUP BY 1, 2)""",
        EFFORTS_SQL,
        FIRST_SQL,
    ),
)
def race_headline(spark, sf_dir):
    return aggregates.race_headline(counted_efforts(spark, sf_dir))


def window_seasons(spark, sf_dir):
    """The last calendar year has no results yet, so its first race opens the current season."""
    days = race_days(spark, sf_dir).withColumn(
        "have_results", F.col("date_ymd") < F.lit("2001-03-01").cast("date")
    )
    rows = efforts(spark, sf_dir).withColumns(
        {"name_first": first_name(F.col("name")), "name_last": last_name(F.col("name"))}
    )
    return rows, days


HANDICAP_SQL = """
lim AS (SELECT max(date_ymd) AS latest FROM efforts WHERE date_ymd < DATE '2001-03-01'),
cur AS (SELECT min(season) AS season_current FROM efforts, lim WHERE date_ymd > latest),
recent AS (SELECT DISTINCT season FROM efforts, cur WHERE season < season_current
  ORDER BY season DESC LIMIT 3),
windowed AS (SELECT efforts.*, season_current, overall_valid AND date_ymd <= latest
  AND (season = season_current OR season IN (SELECT season FROM recent)) AS handicap_eligible
  FROM efforts, lim, cur),
per_season AS (SELECT name, season, course, min(overall_mins) AS best_time_mins
  FROM windowed WHERE handicap_eligible GROUP BY 1, 2, 3),
best AS (SELECT name, course, min(best_time_mins + CASE WHEN season <> season_current THEN 3 ELSE 0 END)
  AS best_time_mins_adjust FROM per_season, cur GROUP BY 1, 2),
starts AS (SELECT *, 450 - best_time_mins_adjust AS start_time_mins,
  CAST(floor(best_time_mins_adjust * 60) AS BIGINT) AS b,
  CAST(floor((450 - best_time_mins_adjust) * 60) AS BIGINT) AS s FROM best),
texts AS (SELECT *, printf('%02d:%02d:%02d', b // 3600, b // 60 % 60, b % 60) AS best_time_adjust_hms,
  printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS start_time_hms FROM starts)"""


def handicap_sql(select: str) -> str:
    return sql(select, EFFORTS_SQL, HANDICAP_SQL)


@query(
    "handicap_window",
    handicap_sql(
        "SELECT name, date_ymd, effort, season_current, handicap_eligible FROM windowed"
    ),
)
def handicap_window(spark, sf_dir):
    return handicap.handicap_window(*window_seasons(spark, sf_dir)).select(
        "name", "date_ymd", "effort", "season_current", "handicap_eligible"
    )


@query("best_times", handicap_sql("SELECT name, season, course, best_time_mins FROM per_season"))
def best_times(spark, sf_dir):
    windowed = handicap.handicap_window(*window_seasons(spark, sf_dir))
    return aggregates.best_times(windowed).select("name", "season", "course", "best_time_mins")


@query("handicap_best", handicap_sql("SELECT name, course, best_time_mins_adjust FROM best"))
def handicap_best(spark, sf_dir):
    windowed = handicap.handicap_window(*window_seasons(spark, sf_dir))
    return handicap.handicap_best(windowed).select("name", "course", "best_time_mins_adjust")


@query(
    "start_times",
    handicap_sql("SELECT name, course, start_time_mins, best_time_adjust_hms, start_time_hms FROM texts"),
)
def start_times(spark, sf_dir):
    return handicap.handicaps(*window_seasons(spark, sf_dir)).select(
        "name", "course", "start_time_mins", "best_time_adjust_hms", "start_time_hms"
    )


@query(
    "handicap_table",
    handicap_sql(
        """SELECT course, name, substr(name, 9) AS name_last, 'Entrant' AS name_first,
        regexp_replace(best_time_adjust_hms, '^0', '') AS best_time,
        regexp_replace(start_time_hms, '^0', '') AS start_time FROM texts"""
    ),
)
def handicap_table(spark, sf_dir):
    return handicap.handicap_table(handicap.handicaps(*window_seasons(spark, sf_dir)))


def entrants(spark, sf_dir):
    """All customers enter under upper-case names; segments choose the course."""
    number = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("ENTRANT K"), number).alias("name"),
        F.when(F.col("c_acctbal") < 0, "Intermediate").otherwise("Full").alias("course"),
        F.lit("").alias("chip"),
    )


@query(
    "attach_handicap",
    handicap_sql(
        """SELECT 'Entrant K' || c_custkey AS name, CASE WHEN c_acctbal < 0 THEN 'int' ELSE 'full' END AS course,
        start_time_hms FROM customer LEFT JOIN texts ON texts.name = 'Entrant K' || c_custkey
          AND course = CASE WHEN c_acctbal < 0 THEN 'int' ELSE 'full' END"""
    ),
)
def attach_handicap(spark, sf_dir):
    number = F.col("c_custkey").cast("string")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Entrant K"), number).alias("name"),
        F.when(F.col("c_acctbal") < 0, "int").otherwise("full").alias("course"),
    )
    starts = handicap.handicaps(*window_seasons(spark, sf_dir))
    return joins.attach_handicap(rows, starts, columns=("start_time_hms",))


@query(
    "start_list",
    handicap_sql(
        """SELECT 'Entrant K' || c_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END AS name,
        '' AS chip, CASE WHEN c_acctbal < 0 THEN 'Intermediate' ELSE 'Full' END AS course,
        start_time_hms AS start_time FROM customer LEFT JOIN texts
          ON texts.name = 'Entrant K' || c_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END
          AND course = CASE WHEN c_acctbal < 0 THEN 'int' ELSE 'full' END"""
    ),
)
def start_list(spark, sf_dir):
    starts = handicap.handicaps(*window_seasons(spark, sf_dir))
    return handicap.start_list(entrants(spark, sf_dir), starts, aliases(spark, sf_dir))


# audits and checks -------------------------------------------------------------------------------


@query(
    "name_bib_audit",
    """SELECT season, bib, name, times_used, names FROM (
      SELECT *, count(*) OVER (PARTITION BY season, bib) AS names FROM (
        SELECT year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS season,
          CAST(c_nationkey AS VARCHAR) AS bib, c_name AS name, count(*) AS times_used
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)) WHERE names > 1""",
)
def name_bib_audit(spark, sf_dir):
    """Customers of a nation share its number."""
    customers = table(spark, sf_dir, "customer")
    rows = efforts(spark, sf_dir).select("season", "part", F.col("bib").alias("c_custkey"))
    named = rows.join(customers, "c_custkey").select(
        "season", "part", F.col("c_nationkey").cast("string").alias("bib"), F.col("c_name").alias("name")
    )
    return aggregates.name_bib_audit(named)


@query(
    "check_unique_effort",
    sql(
        "SELECT name, date_ymd, count(*) AS entries FROM efforts GROUP BY 1, 2 HAVING count(*) > 1",
        EFFORTS_SQL,
    ),
)
def check_unique_effort(spark, sf_dir):
    return checks.check_unique_effort(efforts(spark, sf_dir))


@query(
    "check_no_percent",
    "SELECT page_id, url FROM pages WHERE contains(html, '%')",
)
def check_no_percent(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return checks.check_no_percent(pages, "html").select("page_id", "url")


@query(
    "check_totals_resolved",
    sql(
        """SELECT name, date_ymd, recorded FROM wide
        WHERE abs(coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) - recorded) > 1 AND end_bad""",
        WIDE_SQL,
    ),
)
def check_totals_resolved(spark, sf_dir):
    """Disagreements whose last leg is invalid are taken as not resolved."""
    legs = sum((F.coalesce(f"s{i}", F.lit(0.0)) for i in (1, 2, 3)), F.lit(0.0))
    wide = wide_seconds(spark, sf_dir).withColumns(
        {
            "total_disagree": F.abs(legs - F.col("recorded")) > 1,
            "total_resolved": F.when(~F.col("end_bad"), F.lit(True)),
        }
    )
    return checks.check_totals_resolved(wide).select("name", "date_ymd", "recorded")


@query(
    "check_unknown_names",
    """SELECT name, bib, count(*) AS races_bib,
      CAST(sum(count(*)) OVER (PARTITION BY name) AS BIGINT) AS races
    FROM (SELECT 'Entrant K' || o_custkey AS name, o_orderpriority AS bib FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')))
    GROUP BY 1, 2""",
)
def check_unknown_names(spark, sf_dir):
    """History holds one market segment, the confirmed newcomers another."""
    bibs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Entrant K"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("bib"),
        F.lit("Swim").alias("part"),
        F.lit(True).alias("started"),
    )
    known = aliases(spark, sf_dir).select(F.col("name_in").alias("name"))
    return checks.check_unknown_names(bibs, known, newcomers(spark, sf_dir))


@query(
    "check_repeated_bib",
    """SELECT bib, name, times FROM (SELECT l_orderkey * 10 + l_linenumber AS bib, l_partkey AS name,
      count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS times FROM lineitem) WHERE times > 1""",
)
def check_repeated_bib(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bib"),
        F.col("l_partkey").alias("name"),
    )
    return checks.check_repeated_bib(rows)


# tracks ------------------------------------------------------------------------------------------


def points(spark, sf_dir):
    """Customers as points: the balance is the longitude, the balance after a rotation the latitude."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("poi"),
        (F.col("c_acctbal") / 100).alias("lon"),
        ((F.col("c_acctbal") * 37) % 50).alias("lat"),
    )


def tracks(spark, sf_dir):
    """Suppliers of a nation as short tracks, ten balance units per track."""
    balance = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("course"),
        F.floor(balance / 1000).cast("string").alias("part"),
        (balance / 100).alias("lon"),
        ((balance * 37) % 50).alias("lat"),
    )


TRACKS_SQL = """
points AS (SELECT c_custkey AS poi, c_acctbal / 100 AS lon, (c_acctbal * 37) % 50 AS lat FROM customer),
tracks AS (SELECT CAST(s_nationkey AS VARCHAR) AS course, CAST(CAST(floor(s_acctbal / 1000) AS BIGINT)
  AS VARCHAR) AS part, s_acctbal / 100 AS lon, (s_acctbal * 37) % 50 AS lat FROM supplier),
extent AS (SELECT course, part, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax
  FROM tracks GROUP BY 1, 2),
boxes AS (SELECT course, part,
  xmin - 20000.0 / 111195 / cos(radians(greatest(abs(ymin), abs(ymax)))) AS xmin, ymin - 20000.0 / 111195
  AS ymin, xmax + 20000.0 / 111195 / cos(radians(greatest(abs(ymin), abs(ymax)))) AS xmax,
  ymax + 20000.0 / 111195 AS ymax FROM extent)"""


@query("track_extent", sql("SELECT * FROM extent", TRACKS_SQL))
def track_extent(spark, sf_dir):
    return aggregates.track_extent(tracks(spark, sf_dir))


@query(
    "overall_extent",
    sql(
        """SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
        FROM extent""",
        TRACKS_SQL,
    ),
)
def overall_extent(spark, sf_dir):
    return aggregates.overall_extent(aggregates.track_extent(tracks(spark, sf_dir)))


@query(
    "pois_near_course",
    sql(
        """SELECT poi, course, part, lon, lat FROM points JOIN boxes
        ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax""",
        TRACKS_SQL,
    ),
)
def pois_near_course(spark, sf_dir):
    """Points within 20 km of the box of a track."""
    return geo.pois_near_course(points(spark, sf_dir), tracks(spark, sf_dir), 20_000, cell=1.0)


# race headline with bests ------------------------------------------------------------------------


RACE_PB_HEADLINE_SQL = sql(
    """SELECT * EXCLUDE (told, achieved), competitors || ' competitors entered the course' || CASE len(achieved)
      WHEN 0 THEN '' WHEN 1 THEN ', achieving ' || achieved[1]
      ELSE ', achieving ' || achieved[1] || ' and ' || achieved[2] END || '.' AS sentence
    FROM (SELECT *, list_filter([
        CASE WHEN new_pb_overall > 0 THEN new_pb_overall || ' new overall PBs' END,
        CASE WHEN new_pb_legs > 0 THEN new_pb_legs || ' new split PBs: ' || CASE len(told) WHEN 1 THEN told[1]
          WHEN 2 THEN told[1] || ' and ' || told[2] ELSE told[1] || ', ' || told[2] || ', and ' || told[3] END
        END], lambda x: x IS NOT NULL) AS achieved
    FROM (SELECT *, list_filter([
        CASE WHEN "new_pb_Swim" > 0 THEN "new_pb_Swim" || ' in the pool' END,
        CASE WHEN "new_pb_Ride" > 0 THEN "new_pb_Ride" || ' on the bike' END,
        CASE WHEN "new_pb_Run" > 0 THEN "new_pb_Run" || ' on the run' END], lambda x: x IS NOT NULL) AS told
    FROM (SELECT season, race_number, course, is_champ,
      count(CASE WHEN part = 'Swim' THEN 1 END) AS competitors,
      count(CASE WHEN overall_pb AND part = 'Swim' AND course <> 'teams' THEN 1 END) AS new_pb_overall,
      count(CASE WHEN pb AND part = 'Swim' AND course <> 'teams' THEN 1 END) AS "new_pb_Swim",
      count(CASE WHEN pb AND part = 'Ride' AND course <> 'teams' THEN 1 END) AS "new_pb_Ride",
      count(CASE WHEN pb AND part = 'Run' AND course <> 'teams' THEN 1 END) AS "new_pb_Run",
      count(CASE WHEN pb AND course <> 'teams' THEN 1 END) AS new_pb_legs
    FROM (SELECT *, again AND coalesce(split_valid AND duration_mins = min(CASE WHEN split_valid
        THEN duration_mins END) OVER sofar, false) AS pb,
      again AND coalesce(overall_valid AND overall_mins = min(CASE WHEN overall_valid
        THEN overall_mins END) OVER sofar, false) AS overall_pb
      FROM (SELECT *, max(cumulative_mins) OVER effort AS overall_mins,
          bool_and(cumulative_valid) OVER effort AS overall_valid,
          row_number() OVER (PARTITION BY name, season, part ORDER BY date_ymd) <> 1 AS again
        FROM leg_times WINDOW effort AS (PARTITION BY name, date_ymd))
      WINDOW sofar AS (PARTITION BY name, season, course, part ORDER BY date_ymd)) GROUP BY 1, 2, 3, 4)))""",
    WIDE_SQL,
    LEG_TIMES_SQL,
)


# the second name is that of an earlier round
@query("race_pb_headline_overall", RACE_PB_HEADLINE_SQL)
@query("race_pb_headline", RACE_PB_HEADLINE_SQL)
def race_pb_headline(spark, sf_dir):
    """New bests of legs and of whole efforts."""
    whole = {"overall_mins": F.max("cumulative_mins"), "overall_valid": F.bool_and("cumulative_valid")}
    timed = spread.group_values(leg_times(spark, sf_dir), ["name", "date_ymd"], whole)
    rows = totals.first_race(totals.running_entries(timed, order=("date_ymd",)))
    best = bests.running_best(rows, {f"running_best_{m}": bests.MEASURES[m] for m in ("leg", "overall")}, order=("date_ymd",))
    for m in ("leg", "overall"):
        best = bests.new_pb(best, f"new_pb_{m}", bests.MEASURES[m][0], f"running_best_{m}")
    return aggregates.race_pb_headline(best)
