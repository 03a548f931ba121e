"""Readers and writers: the given tables are written in the exports' formats and read back.

All files go to the shared folder of the session under a name of their own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lapledger.driver.registry import query
from lapledger.driver.summaries import TRACKS_SQL, entrants, handicap_sql, tracks, window_seasons
from lapledger.driver.views import (
    CALENDAR_SQL,
    EFFORTS_SQL,
    SEASON_HEADERS,
    WIDE_SQL,
    aliases,
    efforts,
    export_time,
    history_wide,
    place_sql,
    problems,
    race_days,
    sql,
    table,
    wide_seconds,
)
from lapledger.functions.times import time_seconds
from lapledger.model import LEGS
from lapledger.operators import bests, geo, handicap, ranks
from lapledger.operators.clean import render_places
from lapledger.operators.joins import POSITION, apply_aliases, attach_calendar, attach_problems
from lapledger.operators.update import apply_overrides
from lapledger.plans import reports
from lapledger.session import new_path
from lapledger.sources import readers, writers

SHORT_DAY = "d/M/yyyy"


def written_csv(df, label, **options):
    path = new_path(df.sparkSession, label)
    df.write.options(**{"header": True, **options}).csv(path)
    return path


def short_day(column="date_ymd"):
    return F.date_format(column, SHORT_DAY)


@query(
    "read_calendar",
    sql(
        """SELECT season, race_number, date_ymd, race_type, cancelled, scheduled, cancelled_reason,
        nullif(report_id, '') AS report_id FROM cal0""",
        CALENDAR_SQL,
    ),
)
def read_calendar(spark, sf_dir):
    days = race_days(spark, sf_dir).withColumn("date_ymd", short_day())
    return readers.read_calendar(spark, written_csv(days, "calendar")).drop(POSITION)


def event_calendar(spark, sf_dir):
    """Each day of the events is a race of one season with a course per event type."""
    day = F.to_date("ts")
    rows = table(spark, sf_dir, "events").select(
        day.alias("date_ymd"), F.col("event_type").alias("course")
    )
    return rows.distinct().select(
        F.lit("2023-2024").alias("season"),
        "date_ymd",
        "course",
        F.lit(False).alias("is_champ"),
        F.dayofmonth("date_ymd").alias("race_number"),
        F.lit("Standard").alias("race_type"),
    )


@query(
    "read_results",
    """SELECT '2023-2024' AS season, CAST(ts AS DATE) AS date_ymd, event_type AS course, false AS is_champ,
      CAST(day(ts) AS INTEGER) AS race_number, 'Standard' AS race_type, CAST(event_id AS VARCHAR) AS bib,
      'User ' || user_id AS name, CAST(floor(value * 20) / 2 AS DOUBLE) AS swim_seconds,
      CASE WHEN event_type IN ('click', 'view') THEN CAST(floor(value * 20) / 2 AS DOUBLE) END
        AS run_seconds,
      CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE 'yes' END AS chip FROM events""",
)
def read_results(spark, sf_dir):
    """Events as exports of two kinds: other columns, another order and other spellings."""
    text = export_time(F.floor(F.col("value") * 20) / 2)
    rows = table(spark, sf_dir, "events").select(
        F.lit("2023-2024").alias("season"),
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("folder"),
        F.col("event_id").cast("string").alias("Bib"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("Name"),
        text.alias("lap"),
    )
    lapped = F.col("folder").isin("click", "view")
    place = ["season", "day", "folder"]
    path = new_path(spark, "exports")
    first = rows.filter(lapped).select(
        *place, F.lit("-").alias("Place"), "Bib", "Name", F.col("lap").alias("Lap 1"),
        F.lit("-").alias("Lap 2"), F.col("lap").alias("Lap 3"),
    )
    second = rows.filter(~lapped).select(
        *place, "Name", F.lit("yes").alias("Chip id"), F.col("lap").alias("Lap.1"), "Bib"
    )
    for part in (first, second):
        # one writer task per few folders instead of every task writing into every folder
        part.hint("rebalance", *place).write.mode("append").partitionBy(*place).csv(
            path, sep="\t", header=True
        )
    found = readers.read_results(
        spark, path, event_calendar(spark, sf_dir), file_filter="*.csv"
    )
    return found.select(
        "season",
        "date_ymd",
        "course",
        "is_champ",
        "race_number",
        "race_type",
        "bib",
        "name",
        time_seconds(F.col("Swim")).alias("swim_seconds"),
        time_seconds(F.col("Run")).alias("run_seconds"),
        "chip",
    )


LEG_ROWS = "(VALUES ('Swim', '0:10:00.0'), ('Ride', '0:30:00.0'), ('Run', '0:20:00.0')) p(part, duration_import)"


@query(
    "read_participation",
    sql(
        f"""SELECT e.date_ymd, e.course, e.name, e.is_champ, p.part, p.duration_import, true AS started,
        true AS participation_only, cal1.season, cal1.race_number, cal1.race_type
        FROM efforts e LEFT JOIN cal1 ON e.date_ymd = cal1.date_ymd AND e.course = cal1.course
          AND e.is_champ = cal1.is_champ, {LEG_ROWS}""",
        EFFORTS_SQL,
        CALENDAR_SQL,
    ),
)
def read_participation(spark, sf_dir):
    listed = efforts(spark, sf_dir).select(
        short_day().alias("date_ymd"), "course", "name", "is_champ"
    )
    courses = readers.expanded_calendar(race_days(spark, sf_dir)).withColumn("course_nice", F.col("course"))
    read = readers.read_participation(spark, written_csv(listed, "participation"), courses)
    return read.drop("course_nice")


@query(
    "read_team_sheets",
    f"""SELECT '2020-2021' AS season, CAST(s_nationkey AS INTEGER) AS race_number, DATE '2021-01-23' AS date_ymd,
      CAST(s_suppkey AS VARCHAR) AS team_number, r.racer_ref, s_name || r.ending AS name, 'teams' AS course,
      false AS is_champ, p.part, p.duration_import, true AS started, true AS participation_only,
      'Super Teams' AS race_type
    FROM supplier, (VALUES ('Racer 1', ' a'), ('Racer 2', ' b'), ('Racer 3', ' c')) r(racer_ref, ending),
      {LEG_ROWS}""",
)
def read_team_sheets(spark, sf_dir):
    """Every supplier sends a team of three."""
    sheets = table(spark, sf_dir, "supplier").select(
        F.lit("2020-2021").alias("season"),
        F.col("s_nationkey").alias("race_number"),
        F.lit("23/1/2021").alias("date_ymd"),
        F.col("s_suppkey").alias("Team No"),
        *[
            F.concat("s_name", F.lit(f" {letter}")).alias(f"Racer {i}")
            for i, letter in enumerate("abc", 1)
        ],
    )
    race = spark.range(1).select(
        F.lit("2021-01-23").cast("date").alias("date_ymd"),
        F.lit("teams").alias("course"),
        F.lit(False).alias("is_champ"),
        F.lit("Super Teams").alias("course_nice"),
        F.lit("Super Teams").alias("race_type"),
    )
    return readers.read_team_sheets(spark, written_csv(sheets, "teams"), race).drop("course_nice")


HISTORY_ROWS = " UNION ALL ".join(
    f"""SELECT name, '{y}-{y + 1}' AS season, CAST(nullif(count(CASE WHEN year(o_orderdate) = {y}
    THEN 1 END), 0) AS INTEGER) AS entries FROM named GROUP BY name"""
    for y in range(1995, 2002)
)


@query(
    "read_history_totals",
    sql(
        HISTORY_ROWS,
        """
named AS (SELECT o_orderdate, 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B'
  ELSE '' END AS name FROM orders LEFT JOIN customer ON c_custkey = o_custkey)""",
    ),
)
def read_history_totals(spark, sf_dir):
    path = written_csv(history_wide(spark, sf_dir), "history")
    return readers.read_history_totals(spark, path, SEASON_HEADERS, aliases(spark, sf_dir))


@query(
    "read_aliases",
    """SELECT 'entrant k' || c_custkey AS name_in, 'ENTRANT K' || c_custkey || ' b' AS name_out FROM customer
    WHERE c_mktsegment = 'BUILDING'""",
)
def read_aliases(spark, sf_dir):
    listed = aliases(spark, sf_dir).withColumn("other", F.lit(None).cast("string"))
    return readers.read_aliases(spark, written_csv(listed, "aliases")).drop(POSITION)


PROBLEM_ROWS = " UNION ALL ".join(
    f"""SELECT date_ymd, 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END
      AS name, '{leg}' AS part, NOT r{i} AS split_valid, {"NOT end_bad" if leg == "Run" else "true"}
      AS cumulative_valid FROM wide LEFT JOIN customer ON c_custkey = o_custkey
    WHERE r{i} {"OR end_bad" if leg == "Run" else ""}"""
    for i, leg in enumerate(LEGS, 1)
)


@query("read_timing_problems", sql(PROBLEM_ROWS, WIDE_SQL))
def read_timing_problems(spark, sf_dir):
    listed = problems(spark, sf_dir).withColumn("date_ymd", short_day())
    return readers.read_timing_problems(spark, written_csv(listed, "problems")).drop(POSITION)


@query(
    "read_overrides",
    sql(
        """SELECT date_ymd, 'Entrant K' || o_custkey AS name, CASE WHEN price > 250000 THEN 'int' ELSE 'full' END AS course
        FROM wide WHERE price > 200000""",
        WIDE_SQL,
    ),
)
def read_overrides(spark, sf_dir):
    course = F.when(F.col("price") > 250000, "int").otherwise("full").alias("course")
    listed = wide_seconds(spark, sf_dir).filter("price > 200000").select(short_day().alias("date_ymd"), "name", course)
    return readers.read_overrides(spark, written_csv(listed, "overrides")).drop(POSITION)


@query(
    "update_joins_last_line",
    sql(
        """SELECT date_ymd, 'Entrant K' || o_custkey || CASE WHEN o_custkey % 3 = 0 THEN ' B' WHEN o_custkey % 3 = 1 THEN ' C'
            ELSE '' END AS name, part,
          CASE WHEN status = 'F' AND leg = 1 THEN true WHEN status = 'O' AND leg = 1 THEN false ELSE true END AS split_valid,
          NOT (status = 'O' AND leg = 1) AS cumulative_valid,
          CASE WHEN price <= 150000 THEN course WHEN status = 'F' THEN 'full' ELSE 'int' END AS course,
          CASE WHEN day(date_ymd) % 2 = 0 THEN 'even again' ELSE 'odd' END AS course_nice
        FROM wide, (VALUES ('Swim', 1), ('Ride', 2)) p(part, leg)""",
        WIDE_SQL,
    ),
)
def update_joins_last_line(spark, sf_dir):
    """Lists that hold a key twice, in either order of their values: the later line counts in each lookup."""
    wide = wide_seconds(spark, sf_dir)
    lines = lambda *values: F.explode(F.array(*[F.struct(F.lit(k).alias("line"), *v) for k, v in enumerate(values)])).alias("v")
    key, done = F.col("o_custkey"), F.col("status") == "F"

    flags = lambda split, whole: (split.alias("split_valid"), whole.alias("cumulative_valid"))
    listed = wide.filter("status in ('F', 'O')").select(
        "o_custkey", short_day().alias("date_ymd"), "name", F.lit("Swim").alias("part"), lines(flags(~done, ~done), flags(done, done))
    )
    order = ["v.line", "date_ymd", "o_custkey"]
    listed = listed.repartitionByRange(*order).sortWithinPartitions(*order).select("date_ymd", "name", "part", "v.split_valid", "v.cumulative_valid")
    listed = readers.read_timing_problems(spark, written_csv(listed, "problems"))

    fixed = wide.filter("price > 150000").select(
        "o_custkey",
        short_day().alias("date_ymd"),
        "name",
        lines([F.when(done, "int").otherwise("full").alias("course")], [F.when(done, "full").otherwise("int").alias("course")]),
    )
    fixed = fixed.repartitionByRange(*order).sortWithinPartitions(*order).select("date_ymd", "name", "v.course")
    fixed = readers.read_overrides(spark, written_csv(fixed, "overrides"))

    ending = lambda a, b: F.when(key % 3 == 0, a).otherwise(b)
    named = wide.filter("o_custkey % 3 < 2").select("o_custkey", "name").distinct()
    named = named.select(
        "o_custkey", F.upper("name").alias("name_in"),
        lines(*[[F.concat("name", F.lit(" "), ending(a, b)).alias("name_out")] for a, b in (("c", "b"), ("b", "c"))]),
    )
    named = named.repartitionByRange("v.line", "o_custkey").sortWithinPartitions("v.line", "o_custkey")
    named = readers.read_aliases(spark, written_csv(named.select("name_in", "v.name_out", F.lit(None).cast("string").alias("other")), "aliases"))

    even = F.dayofmonth("date_ymd") % 2 == 0
    days = race_days(spark, sf_dir).select("date_ymd", lines([F.lit("odd").alias("label")], [F.when(even, "even again").otherwise("odd").alias("label")]))
    days = days.repartitionByRange("v.line", "date_ymd").sortWithinPartitions("v.line", "date_ymd")
    blank = lambda kind: F.lit(None).cast(kind)
    days = days.select(
        F.lit("s").alias("season"), F.lit(1).alias("race_number"), short_day().alias("date_ymd"), F.col("v.label").alias("race_type"),
        blank("boolean").alias("cancelled"), blank("boolean").alias("scheduled"), blank("string").alias("cancelled_reason"), blank("string").alias("report_id"),
    )
    days = readers.read_calendar(spark, written_csv(days, "calendar")).withColumnRenamed("race_type", "course_nice")

    legs = F.explode(F.array(F.lit("Swim"), F.lit("Ride"))).alias("part")
    rows = wide.select("date_ymd", "name", legs, "course")
    rows = attach_calendar(rows, days, on=["date_ymd"], columns=["course_nice"])
    rows = apply_overrides(attach_problems(rows, listed), fixed, ["date_ymd", "name"], ["course"])
    return apply_aliases(rows, named).select("date_ymd", "name", "part", "split_valid", "cumulative_valid", "course", "course_nice")


@query(
    "read_start_list",
    """SELECT 'ENTRANT K' || c_custkey AS name, 'ENTRANT' AS first, 'K' || c_custkey AS last,
      CASE WHEN c_acctbal < 0 THEN 'Intermediate' ELSE 'Full' END AS course, CAST(NULL AS VARCHAR) AS chip
    FROM customer""",
)
def read_start_list(spark, sf_dir):
    words = F.split("name", " ")
    listed = entrants(spark, sf_dir).select(
        "name", words[0].alias("first"), words[1].alias("last"), "course", "chip"
    )
    path = written_csv(listed, "start-list", header=False, sep="\t", emptyValue="")
    return readers.read_start_list(spark, path).drop(POSITION)


@query(
    "read_tracks",
    sql("SELECT course, part, lon, lat FROM tracks", TRACKS_SQL),
)
def read_tracks(spark, sf_dir):
    points = tracks(spark, sf_dir).withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    path = new_path(spark, "tracks")
    points.hint("rebalance", "course", "part").write.partitionBy("course", "part").format("xml").option(
        "rowTag", "trkpt"
    ).option("rootTag", "trkseg").save(path)
    return readers.read_tracks(spark, path).select("course", "part", "lon", "lat")


@query(
    "read_course_shapes",
    """SELECT 'trac' AS version, 'ride' AS part, CASE CAST(s_nationkey AS INTEGER) % 2 WHEN 0 THEN 'sprint'
        ELSE 'tempta' END AS distance, s_name AS name, CAST(s_suppkey AS INTEGER) AS seq,
      s_acctbal / 100 AS lon, CAST(s_suppkey AS DOUBLE) AS lat FROM supplier
    UNION ALL SELECT 'trac2', 'run', 'sprint', c_name, CAST(c_custkey AS INTEGER), c_acctbal / 100,
      CAST(c_custkey AS DOUBLE) FROM customer""",
)
def read_course_shapes(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("trac").alias("version"),
        F.lit("ride").alias("part"),
        F.when(F.col("s_nationkey") % 2 == 0, "full").otherwise("int").alias("distance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("seq"),
        (F.col("s_acctbal") / 100).alias("lon"),
        F.col("s_suppkey").cast("double").alias("lat"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit("trac2").alias("version"),
        F.lit("run").alias("part"),
        F.lit("full").alias("distance"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("seq"),
        (F.col("c_acctbal") / 100).alias("lon"),
        F.col("c_custkey").cast("double").alias("lat"),
    )
    later = written_csv(customers, "shapes")
    shapes = readers.read_course_shapes(spark, written_csv(suppliers, "shapes"), extra=[later])
    return geo.rename_distances(shapes).drop(POSITION)


@query(
    "write_start_list",
    handicap_sql(
        """SELECT 'Entrant K' || c_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END AS "Name",
        CASE WHEN c_acctbal < 0 THEN 'Intermediate' ELSE 'Full' END AS course,
        start_time_hms AS "Start time" FROM customer LEFT JOIN texts
          ON texts.name = 'Entrant K' || c_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END
          AND course = CASE WHEN c_acctbal < 0 THEN 'int' ELSE 'full' END"""
    ),
)
def write_start_list(spark, sf_dir):
    starts = handicap.handicaps(*window_seasons(spark, sf_dir))
    listed = handicap.start_list(entrants(spark, sf_dir), starts, aliases(spark, sf_dir))
    path = new_path(spark, "starts")
    writers.write_start_list(listed, path)
    schema = "Name string, chip string, course string, `Start time` string"
    return spark.read.schema(schema).csv(path, header=True).drop("chip")


BESTS_SQL = """SELECT season, course, CAST(bib AS INTEGER) AS bib, name FROM (
  SELECT *, coalesce(overall_valid AND overall_mins = min(CASE WHEN overall_valid THEN overall_mins END)
    OVER (PARTITION BY name, season, course), false) AS pb FROM efforts) WHERE pb"""


@query("write_season_export", sql(BESTS_SQL, EFFORTS_SQL))
def write_season_export(spark, sf_dir):
    rows = bests.season_pb(
        efforts(spark, sf_dir), {"season_pb_overall": bests.MEASURES["overall"]}, bests.OWN
    ).withColumn("overall_seconds", F.col("overall_mins") * 60)
    path = new_path(spark, "bests")
    rows = rows.withColumn("bib", F.col("bib").cast("string"))
    writers.write_season_export(reports.season_best_export(rows), path, form="parquet")
    return spark.read.parquet(path).select("season", "course", "bib", "name")


SNAPSHOT_SQL = sql("SELECT season, name, date_ymd, effort, course, overall_mins FROM efforts", EFFORTS_SQL)


@query("save_snapshot", SNAPSHOT_SQL)
def save_snapshot(spark, sf_dir):
    rows = efforts(spark, sf_dir).select(
        "season", "name", "date_ymd", "effort", "course", "overall_mins"
    )
    path = new_path(spark, "snapshot")
    writers.save_snapshot(rows, path)
    return writers.load_snapshot(spark, path)


@query(
    "load_snapshot",
    sql(
        f"""SELECT name, date_ymd, effort, {place_sql("at_place")} AS place_nice FROM (
          SELECT *, row_number() OVER (PARTITION BY season, race_number, course ORDER BY
            CASE WHEN overall_valid THEN overall_mins END NULLS LAST, name, date_ymd, effort) AS at_place
          FROM efforts)""",
        EFFORTS_SQL,
    ),
)
def load_snapshot(spark, sf_dir):
    """A later job reads what an earlier one placed."""
    placed = ranks.place_overall(
        efforts(spark, sf_dir),
        ("season", "race_number", "course"),
        tie_keys=("name", "date_ymd", "effort"),
    )
    path = new_path(spark, "placed")
    writers.save_snapshot(placed, path)
    loaded = writers.load_snapshot(spark, path)
    return render_places(loaded, {"place_nice": "place_overall"}).select(
        "name", "date_ymd", "effort", "place_nice"
    )
