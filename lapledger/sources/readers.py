"""Readers for calendars, race exports, hand-kept lists, corrections and tracks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapledger.functions.texts import season_text
from lapledger.model import LEGS
from lapledger.operators.calendar import expand_championship, expand_courses
from lapledger.operators.clean import clean_names
from lapledger.operators.joins import POSITION, apply_aliases, attach_calendar
from lapledger.operators.reshape import legs_long
from lapledger.session import settle
from lapledger.spread import attach

DAY = "d/M/yyyy"

# Column headings of the exports, every spelling that occurs.
EXPORT_COLUMNS = {
    "place": ("Place",),
    "bib": ("Bib",),
    "name": ("Name",),
    "distance": ("Distance",),
    "chip": ("Chip id",),
    "adjusted": ("Adjusted time", "Adjusted"),
    "time": ("Time",),
    "handicap": ("Handicap",),
    "Swim": ("Lap 1", "Lap.1"),
    "Ride": ("Lap 2", "Lap.2"),
    "Run": ("Lap 3", "Lap.3"),
}
# Placeholder leg times of participation-only entries.
PLACEHOLDER_TIMES = {"Swim": "0:10:00.0", "Ride": "0:30:00.0", "Run": "0:20:00.0"}
# Summary rows of the historical totals.
SUMMARY_ROWS = (
    "zz",
    "zz ALL YEARS",
    "zz INTERMEDIATE All",
    "zz INTERMEDIATE COMPETITORS",
    "zzTOTAL COMPETITORS",
    "zzTOTAL STARTERS",
)
TOTALS_ID_COLUMNS = ("Name", "Bib", "In List?", "TOTAL")


def _in_file_order(rows: DataFrame, column: str = POSITION) -> DataFrame:
    """With each row's place in the files: path, start of the block, and a number that grows within the block.

    It belongs right behind the reader: the number follows the order in which a task reads its rows.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return rows.withColumn(column, F.struct(path.alias("path"), start.alias("start"), within.alias("row")))


def _csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """The rows of a list, with their ``position``: where several rows have one key, the last in file order counts."""
    settings = {"header": True, "enforceSchema": True, "mode": "PERMISSIVE", **options}
    return _in_file_order(spark.read.options(**settings).schema(schema).csv(path))


def _day(column: str = "date_ymd") -> Column:
    return F.try_to_date(F.trim(F.col(column)), DAY)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The season calendar, one row per date; blank flags are null."""
    schema = (
        "season string, race_number int, date_ymd string, race_type string, cancelled boolean, "
        "scheduled boolean, cancelled_reason string, report_id string"
    )
    return _csv(spark, path, schema).withColumn("date_ymd", _day())


def expanded_calendar(calendar: DataFrame) -> DataFrame:
    """One row per date, course and championship."""
    return expand_championship(expand_courses(calendar))


def _folder(number_from_end: int) -> Column:
    """A folder of the file's path, also when it is written as key=value."""
    folders = F.split(F.col("__path"), "/")
    name = F.try_element_at(folders, F.lit(-1 - number_from_end))
    return F.url_decode(F.regexp_replace(name, "^[^=]*=", ""))


def read_results(
    spark: SparkSession,
    path: str,
    calendar: DataFrame,
    file_filter: str = "*.txt",
    columns: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All race exports below ``path``/season/date/course in one scan, whatever their headings.

    Each line is bound to the headings of its own file, so files with other columns, another order
    or other spellings line up by name and miss what they lack. The folder "champ" is the
    championship on the full course. Files whose race is not in the expanded calendar are left out.
    The headings are the first such line of a file's first block; later ones are no rows.
    """
    columns = columns or EXPORT_COLUMNS
    lines = _in_file_order(
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_filter).text(path)
    )
    cells = F.split(F.regexp_replace("value", "^\ufeff", ""), "\t").alias("__cells")
    is_header = F.array_contains("__cells", "Bib") & F.array_contains("__cells", "Name")
    # lines of other blocks go before they are looked at
    starts = lines.filter(F.col(f"{POSITION}.start") == 0).select(f"{POSITION}.path", f"{POSITION}.row", cells)
    first = F.min_by("__cells", "row").alias("__heads")
    headers = starts.filter(is_header).groupBy(F.col("path").alias("__path")).agg(first)
    # one row per file, written once, so that Spark knows its size when it chooses the join
    headers = settle(headers)
    lines = lines.select(F.col(f"{POSITION}.path").alias("__path"), cells)
    rows = lines.filter(~is_header & (F.size("__cells") > 1))
    bound = attach(rows, headers, ["__path"], "inner")

    def cell(spellings: Sequence[str]) -> Column:
        found = [
            F.get(F.col("__cells"), F.array_position("__heads", s).cast("int") - 1)
            for s in spellings
        ]
        return F.coalesce(*found)

    folder = _folder(1)
    results = bound.select(
        _folder(3).alias("season"),
        F.try_to_date(_folder(2)).alias("date_ymd"),
        F.when(folder == "champ", "full").otherwise(folder).alias("course"),
        (folder == "champ").alias("is_champ"),
        *[cell(spellings).alias(name) for name, spellings in columns.items()],
    )
    races = calendar.select(
        "season", "date_ymd", "course", "is_champ", "race_number", "race_type"
    ).distinct()
    return results.join(races, ["season", "date_ymd", "course", "is_champ"])


def _placeholder_legs(df: DataFrame, ids: Sequence[str], legs: Callable[..., DataFrame]) -> DataFrame:
    timed = df.withColumns({leg: F.lit(text) for leg, text in PLACEHOLDER_TIMES.items()})
    long = legs(timed.select(*ids, *LEGS), ids)
    return long.withColumns({"started": F.lit(True), "participation_only": F.lit(True)})


#: What hand-kept rows take from the calendar, by their date, course and championship.
PARTICIPATION_CALENDAR = ("season", "race_number", "course_nice", "race_type")
TEAM_CALENDAR = ("course_nice", "race_type")


def participation_long(
    listed: DataFrame,
    calendar: DataFrame,
    columns: Sequence[str] = PARTICIPATION_CALENDAR,
    legs: Callable[..., DataFrame] = legs_long,
) -> DataFrame:
    """Listed entrants (date_ymd, course, name, is_champ) with three placeholder legs each, a row each or packed."""
    long = _placeholder_legs(listed, ["date_ymd", "course", "name", "is_champ"], legs)
    return attach_calendar(long, calendar, columns=columns)


def read_participation(spark: SparkSession, path: str, calendar: DataFrame) -> DataFrame:
    """Hand-kept list of who took part, three placeholder legs each."""
    schema = "date_ymd string, course string, name string, is_champ boolean"
    listed = _csv(spark, path, schema).withColumn("date_ymd", _day())
    return participation_long(listed, calendar)


RACERS = ("Racer 1", "Racer 2", "Racer 3")


def team_long(
    sheets: DataFrame,
    calendar: DataFrame,
    columns: Sequence[str] = TEAM_CALENDAR,
    legs: Callable[..., DataFrame] = legs_long,
) -> DataFrame:
    """Team sheets (season, race_number, date_ymd, Team No, Racer 1 to 3): one row per racer and leg, or legs packed."""
    ids = ["season", "race_number", "date_ymd", "team_number"]
    named = sheets.withColumnRenamed("Team No", "team_number")
    each = named.unpivot(ids, list(RACERS), "racer_ref", "name").withColumns(
        {"course": F.lit("teams"), "is_champ": F.lit(False)}
    )
    long = _placeholder_legs(each, [*ids, "racer_ref", "name", "course", "is_champ"], legs)
    return attach_calendar(long, calendar, columns=columns)


def read_team_sheets(spark: SparkSession, path: str, calendar: DataFrame) -> DataFrame:
    """Team sheets with three racers a row: one row per racer and leg."""
    schema = "season string, race_number int, date_ymd string, `Team No` string, " + ", ".join(
        f"`{racer}` string" for racer in RACERS
    )
    return team_long(_csv(spark, path, schema).withColumn("date_ymd", _day()), calendar)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Name corrections, matched on the lower-case name."""
    aliases = _csv(spark, path, "name_in string, name_out string, other string")
    return aliases.select(F.lower("name_in").alias("name_in"), "name_out", POSITION)


def read_history_totals(
    spark: SparkSession,
    path: str,
    seasons: Sequence[str],
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Historical totals with one column per season → name, season, entries; zero means none.

    ``seasons`` are the season headings of the file in order, such as "'98-99".
    """
    fields = [*TOTALS_ID_COLUMNS, *seasons]
    types = ["string"] * len(TOTALS_ID_COLUMNS) + ["int"] * len(seasons)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in zip(fields, types))
    return history_long(_csv(spark, path, schema), seasons, aliases)


def history_long(
    totals: DataFrame, seasons: Sequence[str], aliases: DataFrame | None = None
) -> DataFrame:
    """The wide totals cleaned and unpivoted; spellings of one name are kept as separate rows."""
    people = totals.filter(~F.col("Name").isin(*SUMMARY_ROWS)).withColumnRenamed("Name", "name")
    named = clean_names(people, reverse=True, split=False)
    if aliases is not None:
        named = apply_aliases(named, aliases)
    long = named.unpivot(["name"], list(seasons), "season", "entries")
    return long.select(
        "name", season_text(F.col("season")).alias("season"), F.nullif("entries", F.lit(0)).alias("entries")
    )


def read_timing_problems(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "date_ymd string, name string, part string, split_valid boolean, cumulative_valid boolean"
    )
    return _csv(spark, path, schema).withColumn("date_ymd", _day())


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Entries that were listed on the wrong course, with the right one."""
    listed = _csv(spark, path, "date_ymd string, name string, course string")
    return listed.withColumn("date_ymd", _day())


def read_start_list(spark: SparkSession, path: str) -> DataFrame:
    """Start list without headings, named by position."""
    schema = "name string, first string, last string, course string, chip string"
    listed = _csv(spark, path, schema, header=False, sep="\t")
    return listed.withColumn("name", F.regexp_replace("name", "^\ufeff", ""))


def read_tracks(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """GPX track points in file order: course, part, seq, lat, lon.

    Course and part come from ``files`` (file, course, part) or else from the two folders above the
    file. ``seq`` grows along the track without gaps in order only, not in number.
    """
    points = (
        spark.read.format("xml")
        .option("rowTag", "trkpt")
        .option("recursiveFileLookup", True)
        .schema("_lat double, _lon double, ele double, time string")
        .load(path)
    )
    ordered = _in_file_order(points).select(
        F.col(f"{POSITION}.path").alias("__path"),
        F.struct(F.col(f"{POSITION}.start").alias("__start"), F.col(f"{POSITION}.row").alias("row")).alias("seq"),
        F.col("_lat").alias("lat"),
        F.col("_lon").alias("lon"),
    )
    if files is None:
        tagged = ordered.withColumns({"course": _folder(2), "part": _folder(1)})
    else:
        names = ordered.withColumn("file", F.url_decode(F.try_element_at(F.split("__path", "/"), F.lit(-1))))
        tagged = names.join(files, "file")
    return tagged.select("course", "part", "seq", "lat", "lon")


def read_course_shapes(
    spark: SparkSession, path: str, extra: Sequence[str] = (), dropped: Sequence[str] = ()
) -> DataFrame:
    """Course points (version, part, distance, name, seq, lon, lat) with later files appended.

    Points named in ``dropped`` are stale and left out.
    """
    schema = (
        "version string, part string, distance string, name string, seq int, lon double, lat double"
    )
    shapes = _csv(spark, path, schema)
    for more in extra:
        shapes = shapes.unionByName(_csv(spark, more, schema))
    if dropped:
        shapes = shapes.filter(F.col("name").isNull() | ~F.col("name").isin(*dropped))
    return shapes
