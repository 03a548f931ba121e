"""The season calendar: one row per date becomes one row per date, course and championship."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.model import CHAMPIONSHIP, COURSE_LABELS, course_order

# The courses raced at each type of race.
COURSES_BY_TYPE = {
    "Standard": ("full", "int"),
    CHAMPIONSHIP: ("full", "int"),
    "Double Distance": ("double", "full", "int"),
    "Super Teams": ("teams",),
}


def expand_courses(calendar: DataFrame, race_type: str = "race_type") -> DataFrame:
    """One row per course of the race type."""
    courses = F
    for label, names in COURSES_BY_TYPE.items():
        courses = courses.when(F.col(race_type) == label, F.array(*[F.lit(n) for n in names]))
    return calendar.withColumn("course", F.explode(courses))


def expand_championship(calendar: DataFrame) -> DataFrame:
    """The full course of a championship counts twice: as championship and as general race."""
    twice = (F.col("race_type") == CHAMPIONSHIP) & (F.col("course") == "full")
    flags = F.when(twice, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    return calendar.withColumn("is_champ", F.explode(flags))


def course_labels(df: DataFrame, championship: bool = True) -> DataFrame:
    """Display label of the course with its order; championships are named unless told not to."""
    label = F
    if championship:
        label = label.when((F.col("course") == "full") & F.col("is_champ"), CHAMPIONSHIP)
    for course, text in COURSE_LABELS.items():
        label = label.when(F.col("course") == course, text)
    return df.withColumn("course_nice", label).withColumn(
        "course_order", course_order(F.col("course_nice"))
    )


def calendar_links(calendar: DataFrame, report_url: str = "https://example.org/?p=") -> DataFrame:
    """Report link and race page link; a race without results shows its date only."""
    url = F.concat(F.lit(report_url), F.col("report_id"))
    day = F.date_format("date_ymd", "yyyy-MM-dd")
    ref = F.concat(F.lit("r-"), day)
    page = F.concat(F.lit('<a href="'), ref, F.lit(".html#"), ref, F.lit('">'), day, F.lit("</a>"))
    with_report = F.coalesce(F.col("report_id") != "", F.lit(False))
    html = F.concat(F.lit('<a href = "'), url, F.lit('" target="_blank">link</a>'))
    markdown = F.concat(F.lit("[Club Report]("), url, F.lit('){target="_blank"}'))
    return calendar.withColumns(
        {
            "has_report": with_report,
            "report_link": F.when(with_report, html),
            "report_link_md": F.when(with_report, markdown),
            "race_ref": ref,
            "race_link": F.when(F.col("have_results"), page).otherwise(day),
        }
    )


def results_availability(calendar: DataFrame, results: DataFrame, manual: DataFrame) -> DataFrame:
    """Which calendar rows have timed results or a hand-kept list, and which should have but lack them.

    ``results`` needs season, date_ymd, course and is_champ, ``manual`` needs date_ymd; any number of
    rows each. A blank ``cancelled`` counts as not cancelled.
    """
    keys = ["season", "date_ymd", "course", "is_champ"]
    timed = results.select(*keys).distinct().withColumn("have_file", F.lit(True))
    listed = manual.select("date_ymd").distinct().withColumn("have_manual", F.lit(True))
    joined = calendar.join(timed, keys, "left").join(listed, "date_ymd", "left")
    flags = joined.withColumns(
        {
            "have_file": F.coalesce("have_file", F.lit(False)),
            "have_manual": F.coalesce("have_manual", F.lit(False)),
            "scheduled": F.coalesce("scheduled", F.lit(True)),
        }
    )
    have = F.col("have_file") | F.col("have_manual")
    cancelled = F.coalesce("cancelled", F.lit(False))
    return flags.withColumns(
        {
            "have_results": have,
            "participation_only": F.col("have_manual"),
            "missing_results": ~cancelled & F.col("scheduled") & ~have,
        }
    )


def latest_and_next_race(calendar: DataFrame) -> DataFrame:
    """The last date with results and the first calendar date after it, as one row."""
    held = F.max(F.when(F.col("have_results"), F.col("date_ymd")))
    latest = calendar.agg(held).scalar()
    after = F.when(F.col("date_ymd") > latest, F.col("date_ymd"))
    return calendar.agg(held.alias("latest_race"), F.min(after).alias("next_race"))


def race_results_available(calendar: DataFrame) -> DataFrame:
    """Courses with results per race and their place in the list: championship first, then course."""
    held = calendar.filter("have_results")
    return held.select(
        "season",
        "race_number",
        "course",
        "course_nice",
        "is_champ",
        (F.when(F.col("is_champ"), 0).otherwise(1)).alias("list_group"),
    ).orderBy("season", "race_number", "list_group", "course")


def course_list_by_season(facts: DataFrame) -> DataFrame:
    """Courses present in a season, full before intermediate before double."""
    # List order of the course pages.
    listed = F.array(F.lit("full"), F.lit("int"), F.lit("double"))
    place = F.array_position(listed, F.col("course")).cast("int")
    found = facts.select("season", "course").distinct()
    return found.select("season", "course", place.alias("list_order")).filter("list_order > 0").orderBy(
        "season", "list_order"
    )


def schedule(calendar: DataFrame) -> DataFrame:
    """One row per race with its note: type, participation only, cancelled, no race, no results."""
    shown = calendar.filter(
        ((F.col("course") == "full") | (F.col("race_type") == "Super Teams")) & ~F.col("is_champ")
    )
    cancelled = F.coalesce("cancelled", F.lit(False))
    reason = F.coalesce("cancelled_reason", F.lit(""))
    note = F.concat_ws(
        " - ",
        F.when(F.col("race_type") != "Standard", F.col("race_type")),
        F.when(F.col("participation_only"), F.lit("Participation results only ")),
        F.when(cancelled, F.concat(F.lit("Cancelled due to "), reason)),
        F.when(~F.col("scheduled"), F.concat(F.lit("No race due to "), reason)),
        F.when(
            F.col("scheduled") & ~cancelled & ~F.col("have_results"), "Results not available"
        ),
    )
    return shown.select(
        "season", "race_number", "date_ymd", "race_link", "report_link", note.alias("note")
    ).orderBy("season", "race_number")
