"""The batch from raw results to the fact table: one row per competitor, race and leg.

Steps that look at one competitor all partition by keys that start from the name, so one exchange by
name serves them. Places and records need two more. When a competitor or a course holds more rows
than one task should, the steps cut those groups into blocks instead (``lapledger.spread``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.functions.times import handicap_seconds, seconds_hms, seconds_short, time_seconds
from lapledger.model import EFFORT, FULL_AND_DOUBLE, LAST_LEG, RACE, RECORD
from lapledger.operators import bests, ranks, reconcile, totals
from lapledger.operators.calendar import course_labels
from lapledger.operators.clean import clean_names, render_places, split_names
from lapledger.operators.joins import apply_aliases, attach_prehistory, attach_problems
from lapledger.operators.reshape import PACKED_LEGS, legs_long, legs_unpacked, union_fill
from lapledger.operators.update import (
    apply_overrides,
    cast_places,
    default_flags,
    invalidate,
    mark_started,
    time_of_day_fix,
)
from lapledger.session import new_path, save_buckets, settle, settled_for_now
from lapledger.sources.writers import load_snapshot, save_snapshot

RESULT_IDS = (
    "season",
    "race_number",
    "date_ymd",
    "race_type",
    "course",
    "is_champ",
    "bib",
    "name",
    "place_import",
    "time_overall_import",
    "handicap_import",
    "started",
)


# What each step still reads; all else travels in one struct, which a sort or shuffle copies as a block.
KEYS = ("season", "race_number", "date_ymd", "course", "is_champ", "name", "part", "started")
MEASURES = ("duration_mins", "cumulative_mins", "overall_mins")
FLAGS = ("split_valid", "cumulative_valid", "overall_valid")
TIMING = (
    "participation_only",
    "split_valid",
    "cumulative_valid",
    "duration_seconds",
    "overall_seconds",
    "handicap_seconds",
)
COUNTING = (*KEYS, *MEASURES, *FLAGS)
BESTING = (*COUNTING, "first_race")
#: What steps on an effort read before its times are seconds.
CLEANING = (*KEYS, "participation_only", "time_overall_import", "handicap_import", "duration_import", PACKED_LEGS)
BESTS = ("season_pb_leg", "season_pb_overall")
#: What places and records are made from.
RANKING = (*COUNTING, *BESTS)
#: Rows of a task; the steps on one competitor sort each about ten times.
TASK_ROWS = 150_000
ROW, HOME = "__row", "__home"
#: Where rows without a name lie.
NAMELESS = "\x00"


def packed(df: DataFrame, keep: Sequence[str], into: str) -> DataFrame:
    """All columns but ``keep`` and earlier packs in one struct column.

    The windows of the batch would otherwise copy each of some sixty columns at every sort, in
    generated methods too long for the virtual machine to compile.
    """
    rest = [c for c in df.columns if c not in keep and not c.startswith("__pack")]
    others = [c for c in df.columns if c not in rest]
    return df.select(*others, F.struct(*rest).alias(f"__pack_{into}"))


def unpacked(df: DataFrame) -> DataFrame:
    packs = [c for c in df.columns if c.startswith("__pack")]
    return df.select(*[c for c in df.columns if c not in packs], *[f"{p}.*" for p in packs])


def long_results(
    wide: DataFrame, ids: Sequence[str] = RESULT_IDS, legs: Callable[..., DataFrame] = legs_long
) -> DataFrame:
    """Raw wide results → one row per started competitor and leg; with ``legs_packed`` one per competitor."""
    renamed = cast_places(mark_started(wide)).withColumns(
        {"time_overall_import": F.col("time"), "handicap_import": F.col("handicap")}
    )
    return legs(renamed.filter("started"), ids)


def entered(exports: DataFrame, teams: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Long rows of exports, team sheets and hand-kept lists in one frame; ``entry_source`` tells them apart.

    Rows that are no export's are of participation only and have no bib, place, total or handicap. A team
    with fewer racers than its sheet has places leaves rows without a name, which are no entries.
    """
    sources = {"export": exports, "teams": teams, "listed": listed}
    frames = [df.withColumn("entry_source", F.lit(tag)) for tag, df in sources.items() if df is not None]
    rows = union_fill(*frames)
    if "participation_only" not in rows.columns:
        rows = rows.withColumn("participation_only", F.lit(None).cast("boolean"))
    return default_flags(rows, {"participation_only": False}).filter("entry_source = 'export' or name is not null")


def named_results(long: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Names in standard form and corrected; rows tell whether they are of participation only."""
    if "participation_only" not in long.columns:
        long = long.withColumn("participation_only", F.lit(None).cast("boolean"))
    named = clean_names(default_flags(long, {"participation_only": False}), split=False)
    return named if aliases is None else apply_aliases(named, aliases)


def flagged_results(
    named: DataFrame,
    problems: DataFrame | None = None,
    overrides: DataFrame | None = None,
    clock_races: DataFrame | None = None,
    dupe_dates: DataFrame | None = None,
    hot: bool | None = None,
    by_effort: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Double entries dropped, validity flags set, clock times mended, single rows overridden.

    Packed efforts have a row of each leg, so double entries and overrides are found on the efforts, and the legs
    get rows of their own where they meet their problems.
    """
    whole = PACKED_LEGS in named.columns
    if dupe_dates is not None:
        keys = EFFORT if whole else (*EFFORT, "part")
        named = reconcile.drop_cross_course_dupes(named, dupe_dates, keys, hot=hot)
    fixes = None if overrides is None else by_effort(overrides)
    if whole and fixes is not None:
        # the course is read by none of the steps in between
        named = apply_overrides(named, fixes, EFFORT, ["course"])
    if problems is not None:
        flagged = attach_problems(named, by_effort(problems))
    else:
        flagged = legs_unpacked(named).withColumns({"split_valid": F.lit(True), "cumulative_valid": F.lit(True)})
    if clock_races is not None:
        flagged = time_of_day_fix(flagged, clock_races)
    if not whole and fixes is not None:
        flagged = apply_overrides(flagged, fixes, EFFORT, ["course"])
    return flagged


def cleaned_results(
    long: DataFrame,
    aliases: DataFrame | None = None,
    problems: DataFrame | None = None,
    overrides: DataFrame | None = None,
    clock_races: DataFrame | None = None,
    dupe_dates: DataFrame | None = None,
    hot: bool | None = None,
    by_effort: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Names corrected, double entries dropped, validity flags set, single rows overridden.

    Entries of a corrected name count together, and what drops them goes by the course they were listed on.
    ``by_effort`` deals rows and lookups out by date and name, once the names are right.
    """
    named = by_effort(named_results(long, aliases))
    return flagged_results(named, problems, overrides, clock_races, dupe_dates, hot, by_effort)


def parsed_results(cleaned: DataFrame) -> DataFrame:
    """Time texts become seconds and are left behind; a started leg without a time counts as zero."""
    seconds = cleaned.withColumns(
        {
            "duration_seconds": time_seconds(F.col("duration_import")),
            "overall_seconds": time_seconds(F.col("time_overall_import")),
            "handicap_seconds": F.when(
                F.col("started"), handicap_seconds(F.col("handicap_import"))
            ),
        }
    ).drop("duration_import", "time_overall_import", "handicap_import")
    zero = F.when(F.col("started"), F.lit(0.0))
    return seconds.withColumn("duration_seconds", F.coalesce("duration_seconds", zero))


def timed_results(
    parsed: DataFrame, bad_races: DataFrame | None = None, hot: bool = False
) -> DataFrame:
    """Settled seconds and minutes of each effort, with its validity."""
    # totals are reconciled by validity, so whole bad races lose theirs before
    agreed = reconcile.settled_times(invalidate(parsed, bad_races), hot=hot)
    minutes = agreed.withColumns(
        {
            "duration_mins": F.col("duration_seconds") / 60,
            "cumulative_mins": F.col("cumulative_seconds") / 60,
            "overall_mins": F.col("overall_seconds") / 60,
        }
    )
    return reconcile.final_cumulative(minutes)


def counted_results(
    timed: DataFrame,
    prehistory: DataFrame | None = None,
    newcomers: DataFrame | None = None,
    hot: bool = False,
) -> DataFrame:
    """Running entries and totals of the season and the career.

    Every entry has all legs, so the counts of a leg are those of the season: running counts, totals
    and the last race come from one pass over name, season and leg.
    """
    if prehistory is not None:
        facts = attach_prehistory(timed, prehistory, newcomers)
    else:
        facts = timed.withColumn("entries_before", F.lit(None).cast("long"))
    entry = F.coalesce("started", F.lit(False)).cast("long")
    long_course = F.col("course").isin(*FULL_AND_DOUBLE).cast("long")
    order = [F.col(c) for c in totals.IN_ORDER]
    latest = {"__latest": spread.highest(F.col("race_number"), whole=True)}
    counts = {
        "entries_cumulative": spread.total(entry),
        "entries_cumulative_fd": spread.total(long_course),
        "entries_total": spread.total(entry, whole=True),
        "entries_total_fd": spread.total(long_course, whole=True),
    }
    facts = spread.running(facts, ["name", "season", "part"], order, counts | latest, hot)
    facts = facts.withColumn("is_last_entry", F.col("race_number") == F.col("__latest"))
    career = {
        name.replace("cumulative", "cumulative_all").replace("total", "total_all"): step
        for name, step in counts.items()
    }
    latest = {"__latest": spread.highest(F.col("date_ymd"), whole=True)}
    facts = spread.running(facts.drop("__latest"), ["name", "part"], order, career | latest, hot)
    before = {name: F.col(name) + F.col("entries_before") for name in career}
    return facts.withColumns(
        before
        | {
            "is_last_entry_all": F.col("date_ymd") == F.col("__latest"),
            "first_race": F.col("entries_cumulative") == 1,
        }
    ).drop("__latest")


def best_results(facts: DataFrame, hot: bool = False) -> DataFrame:
    """Own ranks, running bests, new and season bests: all per competitor."""
    facts = ranks.effort_rank_leg(facts, hot=hot)
    facts = ranks.effort_rank_cumulative(facts, hot=hot)
    facts = ranks.effort_rank_overall(facts, hot=hot)
    return bests.effort_has_pb(bests.all_bests(facts, hot=hot), hot=hot)


def placed_results(
    facts: DataFrame,
    hot_race: bool = False,
    hot_record: bool = False,
    hot_name: bool = False,
    rows: int | None = None,
    into: str | None = None,
    columns: Sequence[str] | None = None,
    all_read: Callable[[], None] | None = None,
    own: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Places in the race and records of the season, after what ``own`` adds on a competitor's rows.

    Places and records compare all competitors. The rows wait in the shared folder, where they lie by name in ``rows`` by
    ``TASK_ROWS`` buckets, while keys and numbers alone pass the sorts: first those of ``own``, on the rows of a bucket,
    then the ranks. What is found goes there too, one kind after the other, and meets the rows in their buckets, so whole
    rows are not dealt out again. With a path ``into`` the result is written there, one folder per season. With
    ``columns`` it holds no others, and what nothing reads is not made. A competitor with too many rows for a bucket
    has each row find its ranks by itself. ``all_read`` is called once the rows are written and nothing they were made
    from is read any more, but for lookups of ``own``.
    """
    spark = facts.sparkSession
    tasks = None if rows is None else spread.task_count(spark, rows, TASK_ROWS)
    buckets = None if hot_name else tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = into or new_path(spark, "settled")
    # a row without a name has a place to lie too
    home = F.xxhash64(ROW) if hot_name else F.coalesce("name", F.lit(NAMELESS))
    named = F.col("name") if hot_name else F.when(F.col("name") != NAMELESS, F.col("name"))
    with settled_for_now(spark):
        if columns is not None:
            facts = facts.select(*[c for c in facts.columns if c in {*columns, *RANKING}])
        numbered = facts.withColumn(ROW, F.monotonically_increasing_id())
        kept = settle(numbered.withColumn(HOME, home), buckets, HOME)
        if all_read is not None:
            all_read()

        def found(ranked: DataFrame, *names: str) -> DataFrame:
            return settle(spread.dealt(ranked.select(HOME, ROW, *names), buckets or tasks, HOME), buckets, HOME)

        best, parts = kept, []
        if own is not None:
            # the column that the rows lie by is the name, so that Spark knows the names of a bucket to be together
            lies = F.col("name") if hot_name else F.col(HOME).alias("name")
            made = own(kept.select(lies, ROW, *[c for c in COUNTING if c != "name"]))
            names = [c for c in made.columns if c not in (*COUNTING, ROW)]
            names = [c for c in names if columns is None or c in {*columns, *BESTS}]
            minutes = [
                F.when(F.col(flag), F.col(value)).alias(value)
                for flag, value in (("season_pb_overall", "overall_mins"), ("season_pb_leg", "duration_mins"))
            ]
            compared = dict.fromkeys([*RECORD, "date_ymd", "started"])
            made = made.select(home.alias(HOME), ROW, *names, *compared, named.alias("name"), *minutes)
            best = settle(made, buckets, HOME)
            parts.append((best, [c for c in names if columns is None or c in columns]))

        races = kept.select(ROW, HOME, *RACE, "name", "date_ymd", *MEASURES, *FLAGS)
        places = races if hot_race else spread.dealt(races, tasks, *RACE)
        places = ranks.place_leg(places, hot=hot_race)
        places = ranks.place_cumulative(places, hot=hot_race)
        places = ranks.place_overall(places, hot=hot_race)

        records = best.filter(F.col("started") & (F.col("season_pb_overall") | F.col("season_pb_leg")))
        records = records.select(ROW, HOME, *RECORD, "name", "date_ymd", "started", *BESTS, "overall_mins", "duration_mins")
        records = ranks.record_rank_overall(records, hot=hot_record)
        records = ranks.record_rank_leg(records, hot=hot_record)
        for ranked, names in (
            (places, ["place_leg", "place_cumulative", "place_overall"]),
            (records, ["record_rank_overall", "record_rank_leg"]),
        ):
            names = [name for name in names if columns is None or name in columns]
            if names:
                parts.append((found(ranked, *names), names))
        # what is found comes together first, so that whole rows pass one join; by number, which is quicker to compare
        parts = [part.select(ROW, HOME, *names) for part, names in parts]
        placed = kept.join(reduce(lambda a, b: a.join(b, [ROW, HOME], "left"), parts), [ROW, HOME], "left") if parts else kept
        placed = placed.drop(HOME, ROW) if columns is None else placed.select(*columns)
        season = None if into is None else "season"
        if buckets is not None:
            return spark.table(save_buckets(placed, path, buckets, "name", season))
        save_snapshot(placed, path, season)
    return load_snapshot(spark, path)


def labelled_results(facts: DataFrame) -> DataFrame:
    """Texts for display, made last so that the sorts before carry keys and numbers only."""
    at_finish = F.col("part") == LAST_LEG
    shown = F.when(at_finish, F.col("cumulative_mins") * 60).otherwise(F.col("cumulative_seconds"))
    facts = split_names(facts).withColumns(
        {
            "place_leg_display": F.when(F.col("split_valid"), F.col("place_leg")),
            "duration_hms": seconds_hms(F.col("duration_seconds")),
            "duration_hms_short": seconds_short(F.col("duration_seconds")),
            "cumulative_hms_short": seconds_short(shown),
            "total_overall_hms": seconds_short(F.col("overall_seconds"), keep_hour=True),
            "total_overall_hms_short": seconds_short(F.col("overall_seconds")),
        }
    )
    facts = render_places(
        facts, {"place_leg_nice": "place_leg_display", "place_cumulative_nice": "place_cumulative"}
    )
    return course_labels(bests.display_class(facts), championship=False)


def batch_sizes(long: DataFrame) -> tuple[int, list[int]]:
    """Rows of the batch, and those of the largest competitor, race and season's course.

    An effort with its legs packed has a row of each leg, so what is compared on one leg has a row of each effort.
    """
    held = long.withColumn("name", F.lower("name"))
    if PACKED_LEGS not in long.columns:
        return spread.group_sizes(held.select("name", *RACE), [("name",), RACE, RECORD])
    keys = [("name",), *([c for c in names if c != "part"] for names in (RACE, RECORD))]
    return spread.group_sizes(held, keys, [F.size(PACKED_LEGS), F.lit(1), F.lit(1)])


def build_facts(
    long: DataFrame,
    aliases: DataFrame | None = None,
    problems: DataFrame | None = None,
    overrides: DataFrame | None = None,
    bad_races: DataFrame | None = None,
    clock_races: DataFrame | None = None,
    dupe_dates: DataFrame | None = None,
    prehistory: DataFrame | None = None,
    newcomers: DataFrame | None = None,
    hot: Sequence[bool] | None = None,
    until: str = "labels",
    into: str | None = None,
    columns: Sequence[str] | None = None,
    all_read: Callable[[], None] | None = None,
) -> DataFrame:
    """All steps, or those until "times", "counts" or "places".

    ``long`` has a row per leg, or a row per effort with its legs packed, which is less to deal out. Places are
    written ``into`` a path if there is one, and only ``columns`` of them if these are given; ``all_read`` is called
    once they need no input any more but ``prehistory`` and ``newcomers``.

    ``hot`` tells whether a competitor, a race or a season's course holds more rows than one task
    should; when it is not given, one count finds out. The count is taken by the name in lower case, before the
    lookups unless the rows are written once their names are right; aliases merge only a few spellings of a name.
    """
    with ExitStack() as made:
        # where the rows are not written here, steps on an effort have an exchange of their own, as Spark's joins ask
        # for unless told otherwise; else one by name serves all steps on an effort and a competitor, lookups included
        written = until in ("places", "labels")
        if written:
            made.enter_context(settled_for_now(long.sparkSession))
        named = named_results(long, aliases)
        if written and aliases is not None:
            # aliases have dealt the rows out once: that goes from the disk before they are dealt out again
            named = long = settle(named)
        rows = None
        if hot is None:
            rows, largest = batch_sizes(long)
            hot = [size > spread.group_limit(long) for size in largest]
        hot_name, hot_race, hot_record = hot
        tasks = None if rows is None else spread.task_count(long.sparkSession, rows, TASK_ROWS)

        def by_name(df: DataFrame) -> DataFrame:
            return df if hot_name else spread.dealt(df, tasks, "name")

        def by_effort(df: DataFrame) -> DataFrame:
            return by_name(df) if written or hot_name else spread.dealt(df, tasks, *EFFORT)

        cleaned = flagged_results(
            by_effort(packed(named, CLEANING, "entry")), problems, overrides, clock_races, dupe_dates, hot_name, by_effort
        )
        parsed = packed(parsed_results(cleaned), [*KEYS, *TIMING], "results")
        timed = timed_results(parsed, bad_races, hot_name)
        if until == "times":
            return unpacked(timed)
        if prehistory is not None:
            prehistory = by_name(prehistory)
        if newcomers is not None:
            newcomers = by_name(newcomers)
        if until == "counts":
            return unpacked(counted_results(by_name(packed(timed, COUNTING, "times")), prehistory, newcomers, hot_name))

        def own(facts: DataFrame) -> DataFrame:
            counted = counted_results(facts, prehistory, newcomers, hot_name)
            return unpacked(best_results(packed(counted, BESTING, "counts"), hot_name))

        def read() -> None:
            made.close()
            if all_read is not None:
                all_read()

        placed = placed_results(unpacked(timed), hot_race, hot_record, hot_name, rows, into, columns, read, own)
        return placed if until == "places" else labelled_results(placed)
