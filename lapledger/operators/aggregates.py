"""Summaries: one map-side combined aggregation each, so a hot key costs no more than others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.functions.texts import and_list, counted, separator_after
from lapledger.model import FIRST_LEG, FULL_AND_DOUBLE, LEGS

# Fixed value: the first season of the club's counts.
FIRST_SEASON_YEAR = 1989


def _entries(facts: DataFrame) -> DataFrame:
    """One row per entry: the first-leg rows."""
    return facts.filter(F.col("part") == FIRST_LEG)


def season_summary(
    facts: DataFrame,
    history: DataFrame | None = None,
    before_season: str | None = None,
    courses: Sequence[str] = FULL_AND_DOUBLE,
) -> DataFrame:
    """Entries and full-or-double entries per competitor and season, older seasons appended.

    ``history`` has name, season and entries; its seasons from ``before_season`` on are left out, since
    the detailed results cover them.
    """
    fd = F.count(F.when(F.col("course").isin(*courses), True))
    detailed = _entries(facts).groupBy("name", "season").agg(
        F.count(F.lit(1)).alias("entries"), fd.alias("entries_fd")
    )
    if history is None:
        return detailed
    old = history.select("name", "season", F.col("entries").cast("long").alias("entries"))
    if before_season is not None:
        old = old.filter(F.col("season") < before_season)
    return detailed.unionByName(old.withColumn("entries_fd", F.col("entries")))


def career_summary(seasons: DataFrame) -> DataFrame:
    """Totals, first and latest season and number of seasons per competitor."""
    return (
        seasons.filter(F.col("entries").isNotNull())
        .groupBy("name")
        .agg(
            F.sum("entries_fd").alias("entries_fd"),
            F.sum("entries").alias("entries"),
            F.min("season").alias("first_season"),
            F.max("season").alias("latest_season"),
            F.count(F.lit(1)).alias("season_count"),
        )
    )


def prehistory_totals(history: DataFrame, before_season: str) -> DataFrame:
    """Entries per competitor in the seasons before the detailed results."""
    old = history.filter((F.col("season") < before_season) & F.col("entries").isNotNull())
    return old.groupBy("name").agg(F.sum("entries").cast("long").alias("entries_before"))


def milestones(
    totals: DataFrame, entries: str = "entries_fd", every: int = 50, within: int = 3
) -> DataFrame:
    """Competitors at most ``within`` entries from the next multiple; on a multiple the next counts."""
    distance = (F.lit(every) - F.pmod(F.col(entries), F.lit(every))).cast("int")
    near = totals.withColumn("milestone_distance", distance)
    return near.filter(F.col("milestone_distance") <= within).orderBy("milestone_distance", "name")


def participation_histogram(
    entries: DataFrame, total: str = "entries_total", keys: Sequence[str] = ()
) -> DataFrame:
    """How many competitors have each total, with the head line of its tooltip.

    ``entries`` holds one row per competitor (the last-entry rows).
    """
    counts = entries.groupBy(*keys, total).agg(F.count(F.lit(1)).alias("competitors"))
    head = F.concat(
        F.col("competitors").cast("string"),
        F.lit(" entered "),
        counted(F.col(total), "race", "races"),
        F.lit(":\n"),
    )
    return counts.withColumn("tooltip_head", head).orderBy(*keys, F.col(total).desc())


def participation_histogram_names(
    entries: DataFrame,
    total: str = "entries_total",
    keys: Sequence[str] = (),
    order: Sequence[str] = ("name_last", "name_first", "name"),
    per_column: int = 20,
    hot: bool | None = None,
) -> DataFrame:
    """Who has each total: a row for each name by surname, with its place and what follows it in the tooltip.

    ``name`` and ``separator`` of a total's rows, put together by ``position``, are its text in a chart. No list
    is gathered, however many competitors share a total.
    """
    groups = [*keys, total]
    by = [key for name in order for key in spread.nulls_last(name)]
    placed = spread.running(entries, groups, by, {"position": spread.position()}, hot)
    counts = entries.groupBy(*groups).agg(F.count(F.lit(1)).alias("competitors"))
    sized = spread.attach(placed, counts, groups)
    separator = separator_after(F.col("position"), F.col("competitors"), per_column)
    return sized.select(*groups, "competitors", "position", "name", separator.alias("separator"))


def entries_by_race_course(facts: DataFrame) -> DataFrame:
    """Entries per race and course with the race's total and tooltip; courses are few per race."""
    counts = _entries(facts).groupBy("season", "race_number", "course_nice", "course_order").agg(
        F.count(F.lit(1)).alias("entries"), F.min("date_ymd").alias("date_ymd")
    )
    races = counts.groupBy("season", "race_number").agg(F.sum("entries").alias("entries_race"))
    joined = counts.join(races, ["season", "race_number"])
    text = F.concat(
        F.lit("Race #: "),
        F.col("race_number").cast("string"),
        F.lit("\nDate: "),
        F.date_format("date_ymd", "yyyy-MM-dd"),
        F.lit("\n"),
        F.col("entries").cast("string"),
        F.lit(" entered the "),
        F.col("course_nice"),
        F.lit(" course\n"),
        F.col("entries_race").cast("string"),
        F.lit(" entered all courses"),
    )
    return joined.withColumn("tooltip", text).orderBy("season", "race_number", "course_order")


def entries_by_course(facts: DataFrame) -> DataFrame:
    """Entries per season and course with the fragment of the season's sentence."""
    counts = _entries(facts).groupBy("season", "course_nice", "course_order").agg(
        F.count(F.lit(1)).alias("entries")
    )
    fragment = F.concat(F.col("entries").cast("string"), F.lit(" for "), F.col("course_nice"))
    return counts.withColumn("fragment", fragment).orderBy("season", "course_order")


def season_headline(facts: DataFrame) -> DataFrame:
    """Entries and distinct competitors per season.

    Two plain aggregations: first one row per competitor and season, then counts of those.
    """
    each = _entries(facts).groupBy("season", "name").agg(F.count(F.lit(1)).alias("__n"))
    return each.groupBy("season").agg(
        F.sum("__n").alias("entries"), F.count(F.lit(1)).alias("competitors")
    )


def overall_headline(
    careers: DataFrame, calendar: DataFrame, first_year: int = FIRST_SEASON_YEAR
) -> DataFrame:
    """All entries, competitors and the number of seasons since ``first_year``, as one row."""
    latest = calendar.filter("have_results").agg(
        F.max(F.substring("season", 1, 4).try_cast("int"))
    )
    return careers.agg(
        F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("competitors")
    ).withColumn("seasons", (latest.scalar() - first_year + 1).cast("int"))


def race_progress(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each calendar race with entries, first-timers and running totals of the season.

    Cancelled and unscheduled races count zero entries. Aggregated to one row per race before the
    running sums, so a season's window holds its races only.
    """
    held = _entries(facts).groupBy("season", "race_number").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count(F.when(F.col("first_race"), True)).alias("first_timers"),
    )
    races = calendar.groupBy("season", "race_number").agg(
        F.min("date_ymd").alias("date_ymd"),
        F.max(F.coalesce("cancelled", F.lit(False))).alias("cancelled"),
        F.min(F.coalesce("scheduled", F.lit(True))).alias("scheduled"),
        F.max("have_results").alias("have_results"),
        F.max("cancelled_reason").alias("cancelled_reason"),
    )
    joined = races.join(held, ["season", "race_number"], "left")
    none = F.col("cancelled") | ~F.col("scheduled")
    counts = joined.withColumns(
        {c: F.when(none, F.lit(0)).otherwise(F.col(c)) for c in ("entries", "first_timers")}
    )
    sums = spread.running(
        counts,
        ["season"],
        [F.col("race_number")],
        {
            "entries_cumulative": spread.total(F.coalesce("entries", F.lit(0))),
            "competitors_cumulative": spread.total(F.coalesce("first_timers", F.lit(0))),
            "cancelled_cumulative": spread.total(F.col("cancelled").cast("long")),
        },
    )
    summary = F.concat(
        F.lit("As of Race "),
        F.col("race_number").cast("string"),
        F.lit(" - "),
        F.date_format("date_ymd", "d MMM yyyy"),
        F.lit("\nEntries so far: "),
        F.col("entries_cumulative").cast("string"),
        F.lit("\nCompetitors so far: "),
        F.col("competitors_cumulative").cast("string"),
        F.lit("\nCancelled Races so far: "),
        F.col("cancelled_cumulative").cast("string"),
    )
    # The signs of the cancellation reasons.
    sign = (
        F.when(F.col("cancelled_reason") == "COVID", "mask")
        .when(F.col("cancelled_reason") == "XMAS", "christmas_tree")
        .when(F.col("cancelled_reason") == "New Years", "clinking_glasses")
    )
    return sums.withColumns(
        {
            "entries_label": F.when(F.col("have_results"), F.col("entries")),
            "reason_sign": sign,
            "summary_text": summary,
        }
    )


def race_headline(facts: DataFrame) -> DataFrame:
    """Competitors and first-timers per race with the sentence of its page."""
    counts = _entries(facts).groupBy("season", "race_number").agg(
        F.count(F.lit(1)).alias("competitors"),
        F.count(F.when(F.col("first_race"), True)).alias("first_timers"),
    )
    new = F.when(
        (F.col("race_number") != 1) & (F.col("first_timers") > 0),
        F.concat(
            F.lit(", "),
            F.col("first_timers").cast("string"),
            F.lit(" for the first time this season"),
        ),
    ).otherwise("")
    text = F.concat(
        F.lit("A total of "),
        F.col("competitors").cast("string"),
        F.lit(" competitors entered"),
        new,
        F.lit("."),
    )
    return counts.withColumn("sentence", text)


# Where each leg takes place.
PLACES = {"Swim": "in the pool", "Ride": "on the bike", "Run": "on the run"}


def race_pb_headline(facts: DataFrame) -> DataFrame:
    """Competitors and new bests per race, course and championship, with the page sentence.

    An effort is one first-leg row, so competitors are counted without a distinct.
    """
    keys = ["season", "race_number", "course", "is_champ"]

    def count(condition):
        return F.count(F.when(condition, True))

    measures = [
        count(F.col("new_pb_leg") & (F.col("part") == leg)).alias(f"new_pb_{leg}") for leg in LEGS
    ]
    counts = facts.groupBy(*keys).agg(
        count(F.col("part") == FIRST_LEG).alias("competitors"),
        count(F.col("new_pb_overall") & (F.col("part") == FIRST_LEG)).alias("new_pb_overall"),
        *measures,
    )
    teams = F.col("course") == "teams"
    for name in ["new_pb_overall", *[f"new_pb_{leg}" for leg in LEGS]]:
        counts = counts.withColumn(name, F.when(teams, F.lit(0)).otherwise(F.col(name)).cast("long"))
    splits = sum((F.col(f"new_pb_{leg}") for leg in LEGS), F.lit(0)).cast("long")
    counts = counts.withColumn("new_pb_legs", splits)

    def told(name: str, words: str) -> Column:
        return F.when(F.col(name) > 0, F.concat(F.col(name).cast("string"), F.lit(words)))

    where = and_list(F.array_compact(F.array(*[told(f"new_pb_{leg}", f" {PLACES[leg]}") for leg in LEGS])))
    parts = [told("new_pb_overall", " new overall PBs"), F.concat(told("new_pb_legs", " new split PBs: "), where)]
    achieved = F.array_compact(F.array(*parts))
    return counts.withColumn(
        "sentence",
        F.concat(
            F.col("competitors").cast("string"),
            F.lit(" competitors entered the course"),
            F.when(F.size(achieved) > 0, F.concat(F.lit(", achieving "), and_list(achieved))).otherwise(""),
            F.lit("."),
        ),
    )


def best_times(facts: DataFrame, eligible: str = "handicap_eligible") -> DataFrame:
    """Best overall minutes per competitor, season and course among eligible rows."""
    return facts.filter(F.col(eligible)).groupBy("name", "season", "course").agg(
        F.min("overall_mins").alias("best_time_mins"),
        F.min("name_last").alias("name_last"),
        F.min("name_first").alias("name_first"),
    )


def name_bib_audit(facts: DataFrame) -> DataFrame:
    """Bibs used by more than one name in a season, one row per bib and name."""
    used = (
        _entries(facts)
        .filter(F.col("bib").isNotNull() & ~F.col("bib").isin("", "-"))
        .groupBy("season", "bib", "name")
        .agg(F.count(F.lit(1)).alias("times_used"))
    )
    shared = used.groupBy("season", "bib").agg(F.count(F.lit(1)).alias("names"))
    return used.join(shared.filter("names > 1"), ["season", "bib"])


def track_extent(points: DataFrame, keys: Sequence[str] = ("course", "part")) -> DataFrame:
    """Smallest and largest coordinates per track."""
    return points.groupBy(*keys).agg(
        F.min("lon").alias("xmin"),
        F.min("lat").alias("ymin"),
        F.max("lon").alias("xmax"),
        F.max("lat").alias("ymax"),
    )


def overall_extent(extents: DataFrame) -> DataFrame:
    """The box around all tracks."""
    return extents.agg(
        F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"),
        F.max("ymax").alias("ymax"),
    )
