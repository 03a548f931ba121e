"""Race-like frames made from the given tables, and the same frames as SQL.

An order is an effort: the customer is the competitor, the order date the race, the priority the
course, the lines of the order the legs (line numbers 1, 4, 7 swim; 2, 5 ride; 3, 6 run). A customer
with several orders on a date races with the first. Times are multiples of half a second, so that sums
are exact in any order of addition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapledger.functions.times import seconds_short
from lapledger.model import LEGS
from lapledger.operators.aggregates import prehistory_totals
from lapledger.operators.calendar import (
    calendar_links,
    course_labels,
    expand_championship,
    expand_courses,
    results_availability,
)
from lapledger.operators.joins import apply_aliases
from lapledger.operators.reshape import legs_long, legs_packed
from lapledger.plans.facts import RESULT_IDS, build_facts, entered, labelled_results, long_results
from lapledger.session import new_path, settle, settled_for_now
from lapledger.sources.readers import RACERS, expanded_calendar, history_long, participation_long, team_long

BEFORE_SEASON = "1998-1999"
#: A customer's next order on a date belongs to the entrant so many numbers on.
NEXT_ENTRANT = 1_000_000_000
#: Seconds before the start of races that record the time of day.
CLOCK_START = 6 * 3600
YEARS = tuple(range(1995, 2002))
SEASON_HEADERS = tuple(f"'{y % 100:02d}-{(y + 1) % 100:02d}" for y in YEARS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def season_of(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("-"), (F.year(date) + 1).cast("string"))


def race_type_of(date: Column) -> Column:
    day = F.dayofmonth(date)
    return (
        F.when(day == 15, "Club Championships")
        .when(day == 10, "Double Distance")
        .when(day == 20, "Super Teams")
        .otherwise("Standard")
    )


def course_of(date: Column, priority: Column) -> Column:
    return (
        F.when((F.dayofmonth(date) == 20) & (priority == "5-LOW"), "teams")
        .when(priority.isin("1-URGENT", "4-NOT SPECIFIED"), "full")
        .when(priority == "3-MEDIUM", "double")
        .otherwise("int")
    )


def export_time(seconds: Column) -> Column:
    """M:SS.s, MM:SS.s or H:MM:SS.s, as the exports write times."""
    text = seconds_short(seconds)
    # of seven characters are minutes and seconds only
    return F.when((F.length(text) == 7) & text.startswith("0"), F.substring(text, 2, 6)).otherwise(text)


def efforts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with overall minutes; straight from the scan."""
    date = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Entrant K"), F.col("o_custkey").cast("string")).alias("name"),
        season_of(date).alias("season"),
        F.dayofyear(date).alias("race_number"),
        date.alias("date_ymd"),
        course_of(date, F.col("o_orderpriority")).alias("course"),
        F.lit(False).alias("is_champ"),
        F.lit("Swim").alias("part"),
        F.lit(True).alias("started"),
        F.col("o_orderkey").alias("effort"),
        F.col("o_custkey").alias("bib"),
        (F.floor(F.col("o_totalprice") / 50) / 2 / 60).alias("overall_mins"),
        (F.col("o_orderstatus") != "P").alias("overall_valid"),
    )


EFFORTS_SQL = """
efforts AS (
  SELECT 'Entrant K' || o_custkey AS name, year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS season,
         CAST(dayofyear(o_orderdate) AS INTEGER) AS race_number, CAST(o_orderdate AS DATE) AS date_ymd,
         CASE WHEN day(o_orderdate) = 20 AND o_orderpriority = '5-LOW' THEN 'teams'
              WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'full'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'double' ELSE 'int' END AS course,
         false AS is_champ, 'Swim' AS part, true AS started, o_orderkey AS effort, o_custkey AS bib,
         floor(o_totalprice / 50) / 2 / 60 AS overall_mins, o_orderstatus <> 'P' AS overall_valid
  FROM orders)"""


def wide_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, an effort, with the seconds and marks of its legs.

    A customer's further orders on a date are efforts of further entrants, with numbers of their own. A leg
    lasts as long as the prices of all its lines add up to.
    """
    date = F.to_date("o_orderdate")
    again = F.row_number().over(Window.partitionBy("o_custkey", date).orderBy("o_orderkey")) - 1
    first = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + F.lit(NEXT_ENTRANT) * again).alias("o_custkey"),
        date.alias("date_ymd"),
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    leg = (F.col("l_linenumber") - 1) % 3
    returned = F.col("l_returnflag") == "R"
    measures = []
    for i in range(3):
        mine = leg == i
        cents = F.sum(F.when(mine, F.round(F.col("l_extendedprice") * 100).cast("long")))
        measures += [
            (F.floor(cents / 1250) / 2).alias(f"s{i + 1}"),
            F.bool_or(mine & returned).alias(f"r{i + 1}"),
        ]
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        *measures,
        F.bool_or((leg == 2) & returned & (F.col("l_linestatus") == "F")).alias("end_bad"),
        F.max(F.when(leg == 0, F.col("l_discount"))).alias("discount"),
        F.max(F.when(leg == 0, F.col("l_tax"))).alias("tax"),
    )
    joined = first.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    date, handicap = F.col("date_ymd"), F.round(F.col("discount") * 100) * 15
    type_, course = race_type_of(date), course_of(date, F.col("priority"))
    champ = (type_ == "Club Championships") & (course == "full") & (F.col("status") == "F")
    total = sum((F.coalesce(f"s{i}", F.lit(0.0)) for i in (1, 2, 3)), F.lit(0.0))
    total = total + F.when(F.col("tax") > 0.06, 120.0).otherwise(0.0)
    return joined.select(
        "o_custkey",
        F.concat(F.lit("Entrant K"), F.col("o_custkey").cast("string")).alias("name"),
        season_of(date).alias("season"),
        F.dayofyear(date).alias("race_number"),
        "date_ymd",
        type_.alias("race_type"),
        course.alias("course"),
        champ.alias("is_champ"),
        "status",
        "price",
        *[f"s{i}" for i in (1, 2, 3)],
        *[F.coalesce(f"r{i}", F.lit(False)).alias(f"r{i}") for i in (1, 2, 3)],
        F.coalesce("end_bad", F.lit(False)).alias("end_bad"),
        F.when(F.col("status") != "P", total).alias("recorded"),
        F.when(
            F.col("discount") > 0, F.when(F.col("tax") < 0.04, -handicap).otherwise(handicap)
        ).alias("handicap_s"),
    )


WIDE_SQL = """
o1 AS (
  SELECT o_custkey + 1000000000 * (row_number() OVER (
           PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) - 1) AS o_custkey,
         CAST(o_orderdate AS DATE) AS date_ymd, o_orderkey, o_orderpriority AS priority,
         o_orderstatus AS status, o_totalprice AS price
  FROM orders),
lines AS (
  SELECT l_orderkey,
         floor(sum(CASE WHEN (l_linenumber - 1) % 3 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) / 1250) / 2 AS s1,
         floor(sum(CASE WHEN (l_linenumber - 1) % 3 = 1 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) / 1250) / 2 AS s2,
         floor(sum(CASE WHEN (l_linenumber - 1) % 3 = 2 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) / 1250) / 2 AS s3,
         bool_or((l_linenumber - 1) % 3 = 0 AND l_returnflag = 'R') AS r1,
         bool_or((l_linenumber - 1) % 3 = 1 AND l_returnflag = 'R') AS r2,
         bool_or((l_linenumber - 1) % 3 = 2 AND l_returnflag = 'R') AS r3,
         bool_or((l_linenumber - 1) % 3 = 2 AND l_returnflag = 'R' AND l_linestatus = 'F') AS end_bad,
         max(CASE WHEN (l_linenumber - 1) % 3 = 0 THEN l_discount END) AS discount,
         max(CASE WHEN (l_linenumber - 1) % 3 = 0 THEN l_tax END) AS tax
  FROM lineitem GROUP BY 1),
w0 AS (
  SELECT o_custkey, 'Entrant K' || o_custkey AS name,
         year(date_ymd) || '-' || (year(date_ymd) + 1) AS season,
         CAST(dayofyear(date_ymd) AS INTEGER) AS race_number, date_ymd,
         CASE day(date_ymd) WHEN 15 THEN 'Club Championships' WHEN 10 THEN 'Double Distance'
              WHEN 20 THEN 'Super Teams' ELSE 'Standard' END AS race_type,
         CASE WHEN day(date_ymd) = 20 AND priority = '5-LOW' THEN 'teams'
              WHEN priority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'full'
              WHEN priority = '3-MEDIUM' THEN 'double' ELSE 'int' END AS course,
         status, price, s1, s2, s3, coalesce(r1, false) AS r1, coalesce(r2, false) AS r2,
         coalesce(r3, false) AS r3, coalesce(end_bad, false) AS end_bad,
         CASE WHEN status <> 'P' THEN coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0)
              + CASE WHEN tax > 0.06 THEN 120 ELSE 0 END END AS recorded,
         CASE WHEN discount > 0 THEN CASE WHEN tax < 0.04 THEN -1 ELSE 1 END
              * round(discount * 100) * 15 END AS handicap_s
  FROM o1 LEFT JOIN lines ON o_orderkey = l_orderkey),
wide AS (
  SELECT *, race_type = 'Club Championships' AND course = 'full' AND status = 'F' AS is_champ,
         NOT (s1 IS NULL AND status IN ('O', 'F')) AS started
  FROM w0)"""


def raw_results(
    spark: SparkSession, sf_dir: str, wide: DataFrame | None = None, clock: Column | None = None
) -> DataFrame:
    """The efforts as an export would hold them: everything is text.

    Where ``clock`` holds, totals are times of day of a race that began at six.
    """
    wide = wide_seconds(spark, sf_dir) if wide is None else wide
    total = F.col("recorded") + (0 if clock is None else F.when(clock, CLOCK_START).otherwise(0))
    blank = F.when(F.col("status") == "O", "-").when(F.col("status") == "F", "")
    first = F.when(F.col("s1").isNull(), blank).otherwise(export_time(F.col("s1")))
    later = {
        leg: F.coalesce(export_time(F.col(f"s{i}")), F.lit("-"))
        for i, leg in ((2, "Ride"), (3, "Run"))
    }
    sign = F.when(F.col("handicap_s") < 0, "-").otherwise("+")
    return wide.select(
        "season",
        "race_number",
        "date_ymd",
        "race_type",
        "course",
        "is_champ",
        F.col("o_custkey").cast("string").alias("bib"),
        F.upper("name").alias("name"),
        F.when(F.col("status") == "P", "-").otherwise("1").alias("place"),
        first.alias("Swim"),
        *[text.alias(leg) for leg, text in later.items()],
        F.coalesce(export_time(total), F.lit("DNF")).alias("time"),
        F.concat(sign, export_time(F.abs("handicap_s"))).alias("handicap"),
        (F.col("race_type") == "Super Teams").alias("participation_only"),
        F.concat(F.lit("r-"), F.date_format("date_ymd", "yyyy-MM-dd")).alias("race_ref"),
        F.date_format("date_ymd", "yyyy-MM-dd").alias("race_link"),
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name corrections: customers of one market segment race under a longer name."""
    number = F.col("c_custkey").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(
            F.concat(F.lit("Entrant k"), number).alias("name_in"),
            F.concat(F.lit("ENTRANT K"), number, F.lit(" b")).alias("name_out"),
        )
    )


def problems(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    """Invalid legs: returned lines; the sum is invalid when the last leg's line is also closed."""
    wide = wide_seconds(spark, sf_dir) if wide is None else wide
    wide = apply_aliases(wide, aliases(spark, sf_dir))
    legs = F.array(
        *[
            F.struct(
                F.lit(leg).alias("part"),
                (~F.col(f"r{i}")).alias("split_valid"),
                (~F.col("end_bad") if leg == "Run" else F.lit(True)).alias("cumulative_valid"),
            )
            for i, leg in enumerate(LEGS, 1)
        ]
    )
    return wide.select("date_ymd", "name", F.inline(legs)).filter(
        ~F.col("split_valid") | ~F.col("cumulative_valid")
    )


def overrides(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    """Efforts listed on the wrong course: the dearest orders belong to the intermediate course."""
    wide = wide_seconds(spark, sf_dir) if wide is None else wide
    wide = apply_aliases(wide, aliases(spark, sf_dir))
    return wide.filter("price > 450000").select("date_ymd", "name", F.lit("int").alias("course"))


def bad_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race_dates(spark, sf_dir, 31)


def race_dates(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """The dates with an order on this day of a month."""
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_ymd"))
    return dates.filter(F.dayofmonth("date_ymd") == day).distinct()


def clock_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Races whose exports have the time of day as total."""
    return race_dates(spark, sf_dir, 5)


def dupe_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Races whose entrants of the other courses are also in the export of the double course."""
    return race_dates(spark, sf_dir, 10)


def on_team_sheet() -> Column:
    """Efforts that are kept on team sheets instead of exports."""
    return F.col("course") == "teams"


def on_list() -> Column:
    """Efforts that are kept on the hand-kept list instead of exports."""
    return (F.dayofmonth("date_ymd") == 29) & F.col("course").isin("full", "int")


def team_sheets(wide: DataFrame) -> DataFrame:
    """Three racers of a race a row, by number; the last team of a race may have fewer."""
    place = F.row_number().over(Window.partitionBy("date_ymd").orderBy("o_custkey")) - 1
    placed = wide.filter(on_team_sheet()).withColumn("place", place)
    team = (F.floor(F.col("place") / 3) + 1).cast("string").alias("Team No")
    racers = [F.max(F.when(F.col("place") % 3 == i, F.upper("name"))).alias(c) for i, c in enumerate(RACERS)]
    return placed.groupBy("season", "race_number", "date_ymd", team).agg(*racers)


def participation_list(wide: DataFrame) -> DataFrame:
    return wide.filter(on_list()).select("date_ymd", "course", F.upper("name").alias("name"), F.lit(False).alias("is_champ"))


def export_rows(wide: DataFrame) -> DataFrame:
    """The efforts that exports hold, some of them twice on the dates with double entries."""
    held = wide.filter(~(on_team_sheet() | on_list()))
    twice = (F.dayofmonth("date_ymd") == 10) & F.col("course").isin("full", "int") & (F.col("status") == "F")
    again = held.filter(twice).withColumns({"course": F.lit("double"), "is_champ": F.lit(False)})
    return held.unionByName(again)


def history_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and year, one column per year, as the historical totals are kept."""
    year = F.year("o_orderdate")
    outside = F.raise_error(F.lit("an order lies outside the seasons of the list")).cast("long")
    counts = [
        F.count(F.when(year == y, True)).cast("int").alias(header)
        for y, header in zip(YEARS, SEASON_HEADERS)
    ]
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(*counts, F.when(F.count_if(~year.isin(*YEARS)) > 0, outside).otherwise(F.count(F.lit(1))).cast("int").alias("TOTAL"))
        .select(
            F.concat(F.lit("K"), F.col("o_custkey").cast("string"), F.lit(" ENTRANT")).alias("Name"),
            F.col("o_custkey").cast("string").alias("Bib"),
            F.lit("Y").alias("In List?"),
            "TOTAL",
            *[F.col(f"`{header}`") for header in SEASON_HEADERS],
        )
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_long(history_wide(spark, sf_dir), SEASON_HEADERS, aliases(spark, sf_dir))


def newcomers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .select(F.concat(F.lit("Entrant K"), F.col("c_custkey").cast("string")).alias("name"))
    )


NAMED_SQL = """
kinds AS (
  SELECT *, CASE WHEN course = 'teams' THEN 'teams' WHEN day(date_ymd) = 29 AND course IN ('full', 'int') THEN 'listed'
         ELSE 'export' END AS entry_source FROM wide),
entries AS (
  SELECT * FROM kinds WHERE started OR entry_source <> 'export'
  UNION ALL
  SELECT * REPLACE ('double' AS course, false AS is_champ) FROM kinds
  WHERE started AND entry_source = 'export' AND day(date_ymd) = 10 AND course IN ('full', 'int') AND status = 'F'),
counted AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, date_ymd) AS times FROM entries),
single AS (SELECT * FROM counted WHERE NOT (day(date_ymd) = 10 AND times > 1 AND course = 'double')),
clocked AS (
  SELECT *, CASE WHEN day(date_ymd) <> 5 THEN recorded
                 WHEN floor((recorded + 21600) / 3600) = 7 THEN recorded ELSE recorded + 21600 END AS fixed
  FROM single),
named AS (
  SELECT clocked.* EXCLUDE (name, course, s1, s2, s3, recorded, handicap_s, started, is_champ, fixed),
         'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END AS name,
         c_mktsegment AS segment,
         CASE WHEN price > 450000 THEN 'int' ELSE course END AS course,
         CASE WHEN entry_source = 'export' THEN is_champ ELSE false END AS is_champ, true AS started,
         CASE WHEN entry_source <> 'export' THEN 600 WHEN day(date_ymd) = 5 THEN fixed ELSE s1 END AS s1,
         CASE WHEN entry_source <> 'export' THEN 1800 ELSE s2 END AS s2,
         CASE WHEN entry_source <> 'export' THEN 1200 ELSE s3 END AS s3,
         CASE WHEN entry_source = 'export' THEN fixed END AS recorded,
         CASE WHEN entry_source = 'export' THEN handicap_s END AS handicap_s,
         CASE WHEN entry_source = 'export' THEN CAST(o_custkey AS VARCHAR) END AS bib,
         race_type = 'Super Teams' OR entry_source <> 'export' AS participation_only
  FROM clocked LEFT JOIN customer ON c_custkey = o_custkey)"""

TIMED_SQL = """
v1 AS (
  SELECT *, participation_only OR day(date_ymd) = 31 AS lost,
         coalesce(handicap_s + coalesce(s1, 0) > 0, false) AS handicap_valid
  FROM named WHERE started),
v2 AS (
  SELECT *, NOT lost AND NOT r1 AS sv1, NOT lost AND NOT r2 AS sv2, NOT lost AND NOT r3 AS sv3,
         NOT lost AS cv1, NOT lost AS cv2, NOT lost AND NOT end_bad AS cv3,
         NOT lost AND NOT end_bad AS overall_valid,
         coalesce(s1, 0) + CASE WHEN handicap_valid THEN handicap_s ELSE 0 END AS d1,
         coalesce(s2, 0) AS d2, coalesce(s3, 0) AS d3
  FROM v1),
v3 AS (SELECT *, d1 AS c1, d1 + d2 AS c2, d1 + d2 + d3 AS c3,
              CASE WHEN handicap_valid THEN d1 + d2 + d3 ELSE recorded END AS total1 FROM v2),
v4 AS (SELECT *, coalesce(abs(c3 - total1) > 1, false) AS total_disagree FROM v3),
v5 AS (SELECT *, CASE WHEN total_disagree THEN CASE WHEN cv3 THEN 'cumulative' ELSE 'imported' END END
              AS total_resolve FROM v4),
v6 AS (SELECT *, CASE WHEN total_resolve = 'cumulative' THEN c3 ELSE total1 END AS total2,
              CASE WHEN total_resolve = 'imported' THEN total1 ELSE c3 END AS c3b FROM v5),
v7 AS (SELECT *, coalesce(total2, greatest(c1, c2, c3b)) AS overall_seconds FROM v6),
timed AS (
  SELECT season, race_number, date_ymd, race_type, course, is_champ, bib, entry_source,
         name, segment, started, p.part, p.leg, overall_valid, handicap_valid, handicap_s,
         total_disagree, total_resolve, participation_only,
         CASE p.leg WHEN 1 THEN sv1 WHEN 2 THEN sv2 ELSE sv3 END AS split_valid,
         CASE p.leg WHEN 1 THEN cv1 WHEN 2 THEN cv2 ELSE cv3 END AS cumulative_valid,
         CAST(CASE p.leg WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS DOUBLE) AS duration_seconds,
         CAST(CASE p.leg WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE overall_seconds END AS DOUBLE)
           AS cumulative_seconds,
         CAST(overall_seconds AS DOUBLE) AS overall_seconds,
         CASE p.leg WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END / 60 AS duration_mins,
         CASE p.leg WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3b END / 60 AS cumulative_mins,
         CAST(CASE p.leg WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3b END AS DOUBLE) AS cumulative_shown,
         overall_seconds / 60 AS overall_mins, strftime(date_ymd, '%Y-%m-%d') AS race_link,
         split_part(name, ' ', 1) AS name_first, substr(name, 9) AS name_last,
         'a-' || replace(lower(name), ' ', '-') AS athlete_ref
  FROM v7, (VALUES ('Swim', 1), ('Ride', 2), ('Run', 3)) p(part, leg))"""


def hms_sql(seconds: str) -> str:
    return (
        f"printf('%02d:%02d:%02d.%d', CAST(floor({seconds} / 3600) AS BIGINT), "
        f"CAST(floor({seconds} / 60) AS BIGINT) % 60, CAST(floor({seconds}) AS BIGINT) % 60, "
        f"CAST({seconds} * 10 AS BIGINT) % 10)"
    )


def short_sql(seconds: str) -> str:
    """H:MM:SS.s without "0:"."""
    return (
        f"regexp_replace(printf('%d:%02d:%02d.%d', CAST(floor({seconds} / 3600) AS BIGINT), "
        f"CAST(floor({seconds} / 60) AS BIGINT) % 60, CAST(floor({seconds}) AS BIGINT) % 60, "
        f"CAST({seconds} * 10 AS BIGINT) % 10), '^0:', '')"
    )


def place_sql(place: str) -> str:
    return (
        f"CASE WHEN {place} IS NULL THEN 'NA' WHEN {place} % 100 BETWEEN 11 AND 13 THEN {place} || 'th' "
        f"WHEN {place} % 10 = 1 THEN {place} || 'st' WHEN {place} % 10 = 2 THEN {place} || 'nd' "
        f"WHEN {place} % 10 = 3 THEN {place} || 'rd' ELSE {place} || 'th' END"
    )


FACTS_SQL = f"""
h AS (
  SELECT name, CAST(count(*) AS BIGINT) AS before FROM (
    SELECT 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END AS name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE year(o_orderdate) < 1998) GROUP BY 1),
f1 AS (
  SELECT timed.*, CASE WHEN segment = 'MACHINERY' THEN 0 ELSE before END AS entries_before,
         '<a href="' || athlete_ref || '.html#' || athlete_ref || '">' || timed.name || '</a>'
           AS athlete_link
  FROM timed LEFT JOIN h USING (name)),
f2 AS (
  SELECT *,
    CAST(count(*) OVER ns AS BIGINT) AS entries_cumulative,
    CAST(count(CASE WHEN course IN ('full', 'double') THEN 1 END) OVER ns AS BIGINT)
      AS entries_cumulative_fd,
    CAST(count(*) OVER np AS BIGINT) + entries_before AS entries_cumulative_all,
    CAST(count(CASE WHEN course IN ('full', 'double') THEN 1 END) OVER np AS BIGINT) + entries_before
      AS entries_cumulative_all_fd,
    race_number = max(race_number) OVER (PARTITION BY name, season) AS is_last_entry,
    date_ymd = max(date_ymd) OVER (PARTITION BY name) AS is_last_entry_all,
    CAST(row_number() OVER (PARTITION BY name, season, course, part ORDER BY
      CASE WHEN split_valid THEN duration_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS effort_rank_leg,
    CAST(row_number() OVER (PARTITION BY name, season, course, part ORDER BY
      CASE WHEN cumulative_valid THEN cumulative_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS effort_rank_cumulative,
    CAST(row_number() OVER (PARTITION BY name, season, course, part ORDER BY
      CASE WHEN overall_valid THEN overall_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS effort_rank_overall,
    CAST(row_number() OVER (PARTITION BY season, race_number, course, part, is_champ ORDER BY
      CASE WHEN split_valid THEN duration_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS place_leg,
    CAST(row_number() OVER (PARTITION BY season, race_number, course, part, is_champ ORDER BY
      CASE WHEN cumulative_valid THEN cumulative_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS place_cumulative,
    CAST(row_number() OVER (PARTITION BY season, race_number, course, part, is_champ ORDER BY
      CASE WHEN overall_valid THEN overall_mins END NULLS LAST, name, date_ymd, part) AS INTEGER)
      AS place_overall,
    min(CASE WHEN split_valid THEN duration_mins END) OVER own AS low_leg,
    min(CASE WHEN cumulative_valid THEN cumulative_mins END) OVER own AS low_cumulative,
    min(CASE WHEN overall_valid THEN overall_mins END) OVER own AS low_overall,
    min(CASE WHEN split_valid THEN duration_mins END) OVER sofar AS best_leg,
    min(CASE WHEN cumulative_valid THEN cumulative_mins END) OVER sofar AS best_cumulative,
    min(CASE WHEN overall_valid THEN overall_mins END) OVER sofar AS best_overall
  FROM f1
  WINDOW ns AS (PARTITION BY name, season, part ORDER BY date_ymd),
         np AS (PARTITION BY name, part ORDER BY date_ymd),
         own AS (PARTITION BY name, season, course, part),
         sofar AS (PARTITION BY name, season, course, part ORDER BY date_ymd)),
f3 AS (
  SELECT *,
    max(entries_cumulative) OVER (PARTITION BY name, season) AS entries_total,
    max(entries_cumulative_fd) OVER (PARTITION BY name, season) AS entries_total_fd,
    max(entries_cumulative_all) OVER (PARTITION BY name) AS entries_total_all,
    max(entries_cumulative_all_fd) OVER (PARTITION BY name) AS entries_total_all_fd,
    entries_cumulative = 1 AS first_race,
    CASE WHEN split_valid THEN best_leg END AS running_best_leg,
    CASE WHEN cumulative_valid THEN best_cumulative END AS running_best_cumulative,
    CASE WHEN overall_valid THEN best_overall END AS running_best_overall,
    split_valid AND duration_mins = best_leg AND entries_cumulative <> 1 AS new_pb_leg,
    cumulative_valid AND cumulative_mins = best_cumulative AND entries_cumulative <> 1
      AS new_pb_cumulative,
    overall_valid AND overall_mins = best_overall AND entries_cumulative <> 1 AS new_pb_overall,
    split_valid AND duration_mins = low_leg AS season_pb_leg,
    cumulative_valid AND cumulative_mins = low_cumulative AS season_pb_cumulative,
    overall_valid AND overall_mins = low_overall AS season_pb_overall
  FROM f2),
f4 AS (
  SELECT *,
    bool_or(season_pb_leg) OVER (PARTITION BY name, season, course, race_number) AS effort_has_pb,
    CASE WHEN season_pb_overall THEN CAST(row_number() OVER (
      PARTITION BY course, season, part, season_pb_overall ORDER BY overall_mins, name, date_ymd, part)
      AS INTEGER) END AS record_rank_overall,
    CASE WHEN season_pb_leg THEN CAST(row_number() OVER (
      PARTITION BY course, season, part, season_pb_leg ORDER BY duration_mins, name, date_ymd, part)
      AS INTEGER) END AS record_rank_leg
  FROM f3),
facts AS (
  SELECT *,
    CASE WHEN record_rank_leg = 1 THEN part || ' (record)' WHEN NOT split_valid THEN part || ' (invalid)'
         ELSE part END AS display_class,
    CASE WHEN season_pb_leg AND record_rank_leg <> 1 THEN part || ' (PB)'
         WHEN record_rank_leg = 1 THEN part || ' (record)' WHEN NOT split_valid THEN part || ' (invalid)'
         ELSE part END AS display_class_pb,
    {hms_sql("duration_seconds")} AS duration_hms,
    {short_sql("duration_seconds")} AS duration_hms_short,
    {short_sql("cumulative_shown")} AS cumulative_hms_short,
    regexp_replace({hms_sql("overall_seconds")}, '^0', '') AS total_overall_hms,
    {place_sql("CASE WHEN split_valid THEN place_leg END")} AS place_leg_nice,
    {place_sql("place_cumulative")} AS place_cumulative_nice,
    CASE course WHEN 'int' THEN 'Intermediate' WHEN 'full' THEN 'Full'
         WHEN 'double' THEN 'Double Distance' ELSE 'Super Teams' END AS course_nice,
    CAST(CASE course WHEN 'int' THEN 1 WHEN 'full' THEN 2 WHEN 'double' THEN 3 ELSE 4 END AS INTEGER)
      AS course_order
  FROM f4)"""


def sql(select: str, *parts: str) -> str:
    return f"WITH {','.join(parts)}\n{select}" if parts else select


def timed_sql(select: str) -> str:
    return sql(select, WIDE_SQL, NAMED_SQL, TIMED_SQL)


def facts_sql(select: str, *more: str) -> str:
    return sql(select, WIDE_SQL, NAMED_SQL, TIMED_SQL, FACTS_SQL, *more)


def long_rows(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None) -> DataFrame:
    raw = raw_results(spark, sf_dir, wide)
    return long_results(raw, [*RESULT_IDS, "participation_only", "race_ref", "race_link"])


#: What rows of sheets and lists take from the calendar.
FROM_CALENDAR = ("race_type", "race_ref", "race_link")


def batch_rows(
    spark: SparkSession, sf_dir: str, wide: DataFrame, legs: Callable[..., DataFrame] = legs_long
) -> DataFrame:
    """Exports, team sheets and the hand-kept list in one frame of legs, a row each or packed."""
    clock = F.dayofmonth("date_ymd") == 5
    raw = raw_results(spark, sf_dir, export_rows(wide), clock)
    exports = long_results(raw, [*RESULT_IDS, "participation_only", "race_ref", "race_link"], legs)
    day = F.date_format("date_ymd", "yyyy-MM-dd")
    races = expanded_calendar(race_days(spark, sf_dir)).withColumns(
        {"race_ref": F.concat(F.lit("r-"), day), "race_link": day}
    )
    teams = team_long(team_sheets(wide), races, FROM_CALENDAR, legs)
    listed = participation_long(participation_list(wide), races, ("season", "race_number", *FROM_CALENDAR), legs)
    return entered(exports, teams, listed)


def facts(
    spark: SparkSession,
    sf_dir: str,
    wide: DataFrame | None = None,
    until: str = "labels",
    into: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The full batch on the exports, team sheets and lists made from orders and lines.

    The efforts are written to the shared folder once: results, problems and overrides are made from
    them, as they would be read from files. They go as soon as places are all that is left to do.
    """
    with ExitStack() as made:
        if wide is None:
            if until in ("places", "labels"):
                made.enter_context(settled_for_now(spark))
            wide = settle(wide_seconds(spark, sf_dir))
        return build_facts(
            batch_rows(spark, sf_dir, wide, legs_packed),
            aliases=aliases(spark, sf_dir),
            problems=problems(spark, sf_dir, wide),
            overrides=overrides(spark, sf_dir, wide),
            bad_races=bad_races(spark, sf_dir),
            clock_races=clock_races(spark, sf_dir),
            dupe_dates=dupe_dates(spark, sf_dir),
            prehistory=prehistory_totals(history(spark, sf_dir), BEFORE_SEASON),
            newcomers=newcomers(spark, sf_dir),
            until=until,
            into=into,
            columns=columns,
            all_read=made.close,
        )


_SAVED: dict[tuple[str, str], DataFrame] = {}


def saved_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table as the reports read it: written once per session, one folder per season.

    Labels are made from the values of their own row, so they are made when it is read.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SAVED:
        with settled_for_now(spark):
            _SAVED[key] = facts(spark, sf_dir, until="places", into=new_path(spark, "facts"))
    return labelled_results(_SAVED[key])


def race_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar, one row per date with an order; some dates cancelled or unscheduled."""
    date, day = F.col("date_ymd"), F.dayofmonth("date_ymd")
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_ymd")).distinct()
    return days.select(
        season_of(date).alias("season"),
        F.dayofyear(date).alias("race_number"),
        "date_ymd",
        race_type_of(date).alias("race_type"),
        F.when(day == 25, F.lit(True)).alias("cancelled"),
        F.when(day == 28, F.lit(False)).alias("scheduled"),
        F.when(day == 25, "XMAS").when(day == 28, "COVID").alias("cancelled_reason"),
        F.when(day > 15, F.dayofyear(date).cast("string")).otherwise("").alias("report_id"),
    )


def held_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar by course with availability, labels and links.

    Timed results come from started efforts, hand-kept lists from races of the last day of a month.
    """
    courses = expand_championship(expand_courses(race_days(spark, sf_dir)))
    results = wide_seconds(spark, sf_dir).select("season", "date_ymd", "course", "is_champ")
    manual = bad_races(spark, sf_dir)
    return calendar_links(course_labels(results_availability(courses, results, manual)))


CALENDAR_SQL = """
days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_ymd FROM orders),
cal0 AS (
  SELECT year(date_ymd) || '-' || (year(date_ymd) + 1) AS season,
         CAST(dayofyear(date_ymd) AS INTEGER) AS race_number, date_ymd,
         CASE day(date_ymd) WHEN 15 THEN 'Club Championships' WHEN 10 THEN 'Double Distance'
              WHEN 20 THEN 'Super Teams' ELSE 'Standard' END AS race_type,
         CASE WHEN day(date_ymd) = 25 THEN true END AS cancelled,
         CASE WHEN day(date_ymd) = 28 THEN false END AS scheduled,
         CASE day(date_ymd) WHEN 25 THEN 'XMAS' WHEN 28 THEN 'COVID' END AS cancelled_reason,
         CASE WHEN day(date_ymd) > 15 THEN CAST(dayofyear(date_ymd) AS VARCHAR) ELSE '' END AS report_id
  FROM days),
cal1 AS (
  SELECT cal0.*, c.course, c.is_champ
  FROM cal0, (VALUES ('full', false), ('full', true), ('int', false), ('double', false),
                     ('teams', false)) c(course, is_champ)
  WHERE (race_type = 'Super Teams' AND c.course = 'teams')
     OR (race_type <> 'Super Teams' AND c.course IN ('full', 'int') AND NOT c.is_champ)
     OR (race_type = 'Double Distance' AND c.course = 'double')
     OR (race_type = 'Club Championships' AND c.course = 'full' AND c.is_champ))"""

HELD_SQL = """
res AS (SELECT DISTINCT season, date_ymd, course, is_champ, true AS found FROM wide),
cal2 AS (
  SELECT cal1.* EXCLUDE (scheduled), coalesce(scheduled, true) AS scheduled,
         coalesce(found, false) AS have_file, day(date_ymd) = 31 AS have_manual
  FROM cal1 LEFT JOIN res USING (season, date_ymd, course, is_champ)),
cal3 AS (
  SELECT *, have_file OR have_manual AS have_results, have_manual AS participation_only,
         NOT coalesce(cancelled, false) AND scheduled AND NOT (have_file OR have_manual) AS missing_results
  FROM cal2),
held AS (
  SELECT *, report_id <> '' AS has_report,
    CASE WHEN report_id <> '' THEN '<a href = "https://example.org/?p=' || report_id
      || '" target="_blank">link</a>' END AS report_link,
    CASE WHEN report_id <> '' THEN '[Club Report](https://example.org/?p=' || report_id
      || '){target="_blank"}' END AS report_link_md,
    'r-' || strftime(date_ymd, '%Y-%m-%d') AS race_ref,
    CASE WHEN have_results THEN '<a href="r-' || strftime(date_ymd, '%Y-%m-%d') || '.html#r-'
      || strftime(date_ymd, '%Y-%m-%d') || '">' || strftime(date_ymd, '%Y-%m-%d') || '</a>'
      ELSE strftime(date_ymd, '%Y-%m-%d') END AS race_link,
    CASE WHEN course = 'full' AND is_champ THEN 'Club Championships' WHEN course = 'full' THEN 'Full'
      WHEN course = 'int' THEN 'Intermediate' WHEN course = 'double' THEN 'Double Distance'
      ELSE 'Super Teams' END AS course_nice,
    CAST(CASE WHEN course = 'full' AND is_champ THEN 0 WHEN course = 'int' THEN 1 WHEN course = 'full' THEN 2
      WHEN course = 'double' THEN 3 ELSE 4 END AS INTEGER) AS course_order
  FROM cal3)"""


def held_sql(select: str) -> str:
    return sql(select, WIDE_SQL, CALENDAR_SQL, HELD_SQL)
