"""Calendar, conditional updates, reshapes, joins and cleaning jobs on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapledger.driver.registry import query
from lapledger.driver.views import (
    CALENDAR_SQL,
    EFFORTS_SQL,
    WIDE_SQL,
    aliases,
    efforts,
    held_calendar,
    held_sql,
    place_sql,
    race_days,
    raw_results,
    sql,
    table,
    wide_seconds,
)
from lapledger.functions.times import unpadded_time
from lapledger.model import LEGS
from lapledger.operators import calendar, clean, joins, reshape, update
from lapledger.operators.ranks import place
from lapledger.plans.replay import frame_expansion

DATE_KEYS = ["season", "race_number", "date_ymd"]


@query("expand_courses", sql("SELECT season, date_ymd, course FROM cal1 WHERE NOT is_champ", CALENDAR_SQL))
def expand_courses(spark, sf_dir):
    return calendar.expand_courses(race_days(spark, sf_dir)).select("season", "date_ymd", "course")


@query(
    "expand_championship",
    sql("SELECT season, date_ymd, course, is_champ FROM cal1", CALENDAR_SQL),
)
def expand_championship(spark, sf_dir):
    courses = calendar.expand_courses(race_days(spark, sf_dir))
    expanded = calendar.expand_championship(courses)
    return expanded.select("season", "date_ymd", "course", "is_champ")


@query(
    "course_labels",
    held_sql("SELECT season, date_ymd, course, is_champ, course_nice, CASE WHEN course_order > 0 THEN "
             "course_order ELSE 0 END AS course_order FROM held"),
)
def course_labels(spark, sf_dir):
    courses = calendar.expand_courses(race_days(spark, sf_dir))
    labelled = calendar.course_labels(calendar.expand_championship(courses))
    return labelled.select(
        "season", "date_ymd", "course", "is_champ", "course_nice", "course_order"
    )


@query(
    "calendar_links",
    held_sql(
        """SELECT date_ymd, course, is_champ, has_report, report_link, report_link_md, race_ref, race_link
        FROM held"""
    ),
)
def calendar_links(spark, sf_dir):
    return held_calendar(spark, sf_dir).select(
        "date_ymd",
        "course",
        "is_champ",
        "has_report",
        "report_link",
        "report_link_md",
        "race_ref",
        "race_link",
    )


@query(
    "results_availability",
    held_sql(
        """SELECT season, date_ymd, course, is_champ, have_file, have_manual, have_results,
        participation_only, missing_results FROM held"""
    ),
)
def results_availability(spark, sf_dir):
    return held_calendar(spark, sf_dir).select(
        "season",
        "date_ymd",
        "course",
        "is_champ",
        "have_file",
        "have_manual",
        "have_results",
        "participation_only",
        "missing_results",
    )


@query(
    "latest_and_next_race",
    sql(
        """SELECT max(CASE WHEN year(date_ymd) < 2001 THEN date_ymd END) AS latest_race,
        min(CASE WHEN date_ymd > (SELECT max(date_ymd) FROM days WHERE year(date_ymd) < 2001)
          THEN date_ymd END) AS next_race FROM days""",
        CALENDAR_SQL,
    ),
)
def latest_and_next_race(spark, sf_dir):
    """The last calendar year is taken as not raced yet."""
    days = race_days(spark, sf_dir).withColumn("have_results", F.year("date_ymd") < 2001)
    return calendar.latest_and_next_race(days)


@query(
    "schedule",
    held_sql(
        """SELECT season, race_number, date_ymd, race_link, report_link, concat_ws(' - ',
          CASE WHEN race_type <> 'Standard' THEN race_type END,
          CASE WHEN participation_only THEN 'Participation results only ' END,
          CASE WHEN cancelled THEN 'Cancelled due to ' || cancelled_reason END,
          CASE WHEN NOT scheduled THEN 'No race due to ' || cancelled_reason END,
          CASE WHEN scheduled AND NOT coalesce(cancelled, false) AND NOT have_results
            THEN 'Results not available' END) AS note
        FROM held WHERE (course = 'full' OR race_type = 'Super Teams') AND NOT is_champ"""
    ),
)
def schedule(spark, sf_dir):
    return calendar.schedule(held_calendar(spark, sf_dir))


@query(
    "race_results_available",
    held_sql(
        """SELECT season, race_number, course, course_nice, is_champ,
        CAST(CASE WHEN is_champ THEN 0 ELSE 1 END AS INTEGER) AS list_group FROM held WHERE have_results"""
    ),
)
def race_results_available(spark, sf_dir):
    return calendar.race_results_available(held_calendar(spark, sf_dir))


@query(
    "course_list_by_season",
    sql(
        """SELECT DISTINCT season, course, CAST(list_position(['full', 'int', 'double'], course) AS INTEGER)
        AS list_order FROM efforts WHERE course <> 'teams'""",
        EFFORTS_SQL,
    ),
)
def course_list_by_season(spark, sf_dir):
    return calendar.course_list_by_season(efforts(spark, sf_dir))


# conditional updates -----------------------------------------------------------------------------


@query(
    "default_flags",
    sql(
        """SELECT date_ymd, coalesce(cancelled, false) AS cancelled, coalesce(scheduled, true) AS scheduled
        FROM cal0""",
        CALENDAR_SQL,
    ),
)
def default_flags(spark, sf_dir):
    days = race_days(spark, sf_dir).select("date_ymd", "cancelled", "scheduled")
    return update.default_flags(days, {"cancelled": False, "scheduled": True})


@query(
    "mark_started",
    sql("SELECT CAST(o_custkey AS VARCHAR) AS bib, date_ymd, started FROM wide", WIDE_SQL),
)
def mark_started(spark, sf_dir):
    return update.mark_started(raw_results(spark, sf_dir)).select("bib", "date_ymd", "started")


@query(
    "cast_places",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '-' ELSE CAST(o_custkey AS VARCHAR) END AS place,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS place_import FROM orders""",
)
def cast_places(spark, sf_dir):
    number = F.col("o_custkey").cast("string")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "-").otherwise(number).alias("place")
    )
    return update.cast_places(rows)


@query(
    "apply_overrides",
    """SELECT o_orderkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
      WHEN c_mktsegment = 'HOUSEHOLD' THEN 'int' ELSE o_orderpriority END AS course
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def apply_overrides(spark, sf_dir):
    """Customers of two segments have an override, for one of them it is null."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("entrant"), F.col("o_orderpriority").alias("course")
    )
    fixes = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"))
        .select(
            F.col("c_custkey").alias("entrant"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "int").alias("course"),
        )
    )
    return update.apply_overrides(rows, fixes, ["entrant"], ["course"]).select("o_orderkey", "course")


@query(
    "mask_invalid",
    sql(
        """SELECT name, date_ymd, effort, CASE WHEN overall_valid THEN overall_mins END AS overall_sort
        FROM efforts""",
        EFFORTS_SQL,
    ),
)
def mask_invalid(spark, sf_dir):
    masked = update.mask_invalid(
        efforts(spark, sf_dir), {"overall_sort": ("overall_mins", "overall_valid")}
    )
    return masked.select("name", "date_ymd", "effort", "overall_sort")


# reshape -----------------------------------------------------------------------------------------

LEG_UNION = " UNION ALL ".join(
    f"SELECT o_custkey, date_ymd, '{leg}' AS part, s{i} AS seconds FROM wide"
    for i, leg in enumerate(LEGS, 1)
)


@query("legs_long", sql(LEG_UNION, WIDE_SQL))
def legs_long(spark, sf_dir):
    named = wide_seconds(spark, sf_dir).withColumnsRenamed({"s1": "Swim", "s2": "Ride", "s3": "Run"})
    return reshape.legs_long(named, ["o_custkey", "date_ymd"], value="seconds")


@query(
    "legs_wide",
    """SELECT l_orderkey, """
    + ", ".join(
        f"max(CASE WHEN (l_linenumber - 1) % 3 = {i} THEN {column} END) AS {column}_{leg}"
        for column in ("l_extendedprice", "l_quantity", "l_returnflag")
        for i, leg in enumerate(LEGS)
    )
    + " FROM lineitem GROUP BY 1",
)
def legs_wide(spark, sf_dir):
    legs = F.array(*[F.lit(leg) for leg in LEGS])
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "part", F.get(legs, (F.col("l_linenumber") - 1) % 3)
    )
    return reshape.legs_wide(
        rows, ["l_orderkey"], ["l_extendedprice", "l_quantity", "l_returnflag"]
    )


@query(
    "union_fill",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part""",
)
def union_fill(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    return reshape.union_fill(customers, suppliers, parts)


@query(
    "distinct_entities",
    "SELECT p_name AS name, split_part(p_name, ' ', 2) AS name_last FROM part GROUP BY 1, 2",
)
def distinct_entities(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name_last")
    )
    return reshape.distinct_entities(parts)


# joins -------------------------------------------------------------------------------------------


@query(
    "attach_calendar",
    sql(
        """SELECT effort, e.date_ymd, e.course, cal1.season, cal1.race_number, cal1.race_type
        FROM efforts e LEFT JOIN cal1
          ON e.date_ymd = cal1.date_ymd AND e.course = cal1.course AND e.is_champ = cal1.is_champ""",
        EFFORTS_SQL,
        CALENDAR_SQL,
    ),
)
def attach_calendar(spark, sf_dir):
    rows = efforts(spark, sf_dir).select("effort", "date_ymd", "course", "is_champ")
    courses = calendar.expand_championship(calendar.expand_courses(race_days(spark, sf_dir)))
    attached = joins.attach_calendar(rows, courses, columns=("season", "race_number", "race_type"))
    return attached.drop("is_champ")


@query(
    "apply_aliases",
    """SELECT o_orderkey, 'Entrant K' || o_custkey || CASE WHEN c_mktsegment = 'BUILDING' THEN ' B' ELSE '' END
    AS name FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def apply_aliases(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("Entrant K"), F.col("o_custkey").cast("string")).alias("name"),
    )
    return joins.apply_aliases(rows, aliases(spark, sf_dir))


@query(
    "attach_problems",
    sql(
        """SELECT o_custkey, date_ymd, CASE WHEN end_bad THEN false ELSE true END AS cumulative_valid,
        CASE WHEN r3 THEN false ELSE true END AS split_valid FROM wide""",
        WIDE_SQL,
    ),
)
def attach_problems(spark, sf_dir):
    wide = wide_seconds(spark, sf_dir)
    bad = wide.filter("r3 OR end_bad").select(
        "o_custkey",
        "date_ymd",
        (~F.col("r3")).alias("split_valid"),
        (~F.col("end_bad")).alias("cumulative_valid"),
    )
    rows = wide.select("o_custkey", "date_ymd")
    return joins.attach_problems(rows, bad, ["o_custkey", "date_ymd"])


@query(
    "attach_prehistory",
    """SELECT c_name AS name, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE n END AS entries_before
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders
      WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1) ON o_custkey = c_custkey""",
)
def attach_prehistory(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"))
    before = (
        orders.groupBy("o_custkey")
        .agg(F.count("*").alias("entries_before"))
        .join(customers.select("c_custkey", F.col("c_name").alias("name")), F.col("o_custkey") == F.col("c_custkey"))
        .select("name", "entries_before")
    )
    new = customers.filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_name").alias("name"))
    return joins.attach_prehistory(customers.select(F.col("c_name").alias("name")), before, new)


@query(
    "attach_links",
    """SELECT c_name AS name, coalesce(max(CASE WHEN o_orderkey IS NOT NULL THEN '<a href="a-'
      || replace(lower(c_name), ' ', '-') || '.html#a-' || replace(lower(c_name), ' ', '-') || '">' || c_name
      || '</a>' END), c_name) AS athlete_link
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
)
def attach_links(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    ordering = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    facts = clean.split_names(ordering.join(customers, "c_custkey"))
    return joins.attach_links(customers.select("name"), facts)


@query(
    "attach_race_entries",
    sql(
        """SELECT cal0.season, cal0.race_number, entries FROM cal0 LEFT JOIN (
          SELECT season, race_number, count(*) AS entries FROM efforts WHERE overall_valid GROUP BY 1, 2) e
        ON e.season = cal0.season AND e.race_number = cal0.race_number""",
        EFFORTS_SQL,
        CALENDAR_SQL,
    ),
)
def attach_race_entries(spark, sf_dir):
    entries = (
        efforts(spark, sf_dir)
        .filter("overall_valid")
        .groupBy("season", "race_number")
        .agg(F.count("*").alias("entries"))
    )
    days = race_days(spark, sf_dir).select("season", "race_number")
    return joins.attach_race_entries(days, entries, columns=("entries",))


@query(
    "members",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
      SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def members(spark, sf_dir):
    chosen = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.members(orders, chosen.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query(
    "non_members",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def non_members(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.non_members(customers, orders, ["c_custkey"])


@query(
    "frame_expansion",
    "SELECT o_orderkey, CAST(s AS INTEGER) AS stage FROM orders, range(1, 8) t(s)",
)
def frame_expansion_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return frame_expansion(orders, range(1, 8))


# cleaning ----------------------------------------------------------------------------------------


def upper_after_sql(text: str, mark: str) -> str:
    quoted = mark.replace("'", "''")
    return (
        f"array_to_string(list_transform(string_split({text}, '{quoted}'), "
        f"lambda w: upper(w[1]) || w[2:]), '{quoted}')"
    )


def standard_sql(text: str) -> str:
    result = f"(upper(lower({text})[1]) || lower({text})[2:])"
    for mark in (" ", " Mc", "-mc", "'", "-"):
        result = upper_after_sql(result, mark)
    return result


RAW_NAME = "upper(p_name) || ' o''' || lower(p_type) || '-mc' || p_brand || ' mc' || p_type"


@query(
    "clean_names",
    f"""SELECT p_partkey, name, split_part(name, ' ', 1) AS name_first,
      replace(name, split_part(name, ' ', 1) || ' ', '') AS name_last,
      'a-' || regexp_replace(lower(name), '[ '']', '-', 'g') AS athlete_ref
    FROM (SELECT p_partkey, {standard_sql("raw")} AS name
      FROM (SELECT p_partkey, {RAW_NAME} AS raw FROM part))""",
)
def clean_names(spark, sf_dir):
    raw = F.concat(
        F.upper("p_name"),
        F.lit(" o'"),
        F.lower("p_type"),
        F.lit("-mc"),
        F.col("p_brand"),
        F.lit(" mc"),
        F.col("p_type"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", raw.alias("name"))
    return clean.clean_names(parts).select(
        "p_partkey", "name", "name_first", "name_last", "athlete_ref"
    )


@query(
    "reverse_names",
    f"""SELECT p_partkey, {standard_sql("p_type || ' ' || p_name")} AS name FROM part""",
)
def reverse_names(spark, sf_dir):
    """"COLOUR  KIND type" is "Type Colour Kind"; the double space collapses."""
    raw = F.concat(F.replace(F.upper("p_name"), F.lit(" "), F.lit("  ")), F.lit(" "), F.col("p_type"))
    parts = table(spark, sf_dir, "part").select("p_partkey", raw.alias("name"))
    return clean.clean_names(parts, reverse=True, split=False)


HALF = "floor(value * 20) / 2"


@query(
    "parse_times",
    f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN {HALF} END AS seconds,
      CASE WHEN event_type = 'view' THEN -{HALF} ELSE {HALF} END AS handicap_seconds FROM events""",
)
def parse_times(spark, sf_dir):
    from lapledger.driver.views import export_time

    seconds = F.floor(F.col("value") * 20) / 2
    text = export_time(seconds)
    sign = F.when(F.col("event_type") == "view", "-").otherwise("+")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "DNF").otherwise(text).alias("time"),
        F.concat(sign, text).alias("handicap_import"),
    )
    parsed = clean.parse_handicaps(clean.parse_times(rows, {"seconds": "time"}))
    return parsed.select("event_id", "seconds", "handicap_seconds")


def clock_sql(whole: str) -> str:
    return (
        f"printf('%02d:%02d:%02d', CAST({whole} AS BIGINT) // 3600, (CAST({whole} AS BIGINT) // 60) % 60, "
        f"CAST({whole} AS BIGINT) % 60)"
    )


@query(
    "render_times",
    f"""SELECT event_id, {clock_sql("floor(s)")} || '.' || CAST(s * 10 AS BIGINT) % 10 AS plain,
      {clock_sql("floor(s)")} AS floored, {clock_sql("ceil(s)")} AS raised,
      {clock_sql("floor(s + 0.5)")} AS rounded,
      regexp_replace({clock_sql("floor(s)")}, '^0', '') AS unpadded,
      regexp_replace(regexp_replace({clock_sql("floor(s)")}, '^0', ''), '^0:', '') || '.'
        || CAST(s * 10 AS BIGINT) % 10 AS short
    FROM (SELECT event_id, {HALF} AS s FROM events)""",
)
def render_times(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", (F.floor(F.col("value") * 20) / 2).alias("s")
    )
    texts = clean.render_times(rows, {"plain": "s"})
    for name, rounding in (("floored", "floor"), ("raised", "ceiling"), ("rounded", "round")):
        texts = clean.render_times(texts, {name: "s"}, rounding, tenths=False)
    texts = clean.render_short_times(texts, {"short": "s"})
    return texts.withColumn("unpadded", unpadded_time(F.col("floored"))).drop("s")


@query(
    "render_places",
    f"""SELECT event_id, {place_sql("place")} AS place_nice FROM (SELECT event_id, row_number() OVER (
      PARTITION BY user_id ORDER BY value, event_id) AS place FROM events)""",
)
def render_places(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("counts", F.lit(True))
    placed = place(rows, "place", "value", "counts", ["user_id"], ["event_id"])
    return clean.render_places(placed, {"place_nice": "place"}).select("event_id", "place_nice")


AND_SQL = """CASE len(words) WHEN 0 THEN '' WHEN 1 THEN words[1] WHEN 2 THEN words[1] || ' and ' || words[2]
  ELSE array_to_string(words[:-2], ', ') || ', and ' || words[-1] END"""


@query(
    "render_sentences",
    f"""SELECT conv_id, turn, {AND_SQL} AS sentence
    FROM (SELECT conv_id, turn, string_split(replace(text, chr(10), ' '), ' ') AS words
      FROM conversations)""",
)
def render_sentences(spark, sf_dir):
    """The words of each turn as a list."""
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("words"))
    return clean.render_sentences(rows, "words").drop("words")


@query(
    "tooltip_names",
    """SELECT conv_id, turn, array_to_string(list_transform(words, lambda w, i: w || CASE
        WHEN i = len(words) THEN '' WHEN i % (len(words) // 20 + 1) = 0 THEN chr(10) ELSE ', ' END), '')
      AS names_text
    FROM (SELECT conv_id, turn, string_split(replace(text, chr(10), ' '), ' ') AS words
      FROM conversations)""",
)
def tooltip_names(spark, sf_dir):
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("words"))
    return clean.tooltip_names(rows, "words").drop("words")


@query(
    "recode_seasons",
    """SELECT o_orderkey, CASE WHEN yy >= 69 THEN 1900 + yy ELSE 2000 + yy END || '-' ||
      CASE WHEN (yy + 1) % 100 >= 69 THEN 1900 + (yy + 1) % 100 ELSE 2000 + (yy + 1) % 100 END AS season
    FROM (SELECT o_orderkey, (year(o_orderdate) + month(o_orderdate)) % 100 AS yy FROM orders)""",
)
def recode_seasons(spark, sf_dir):
    yy = (F.year("o_orderdate") + F.month("o_orderdate")) % 100
    two = [F.lpad(n.cast("string"), 2, "0") for n in (yy, (yy + 1) % 100)]
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("'"), two[0], F.lit("-"), two[1]).alias("season")
    )
    return clean.recode_seasons(rows)
