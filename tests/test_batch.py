"""The batch on small invented races: exports on disk to facts and reports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.functions.times import time_seconds
from lapledger.operators import checks, reconcile
from lapledger.operators.reshape import legs_packed
from lapledger.plans import reports
from lapledger.plans.facts import (
    batch_sizes,
    build_facts,
    cleaned_results,
    long_results,
    parsed_results,
    placed_results,
    timed_results,
)
from lapledger.sources import readers, writers

HEAD_FULL = "Place\tBib\tName\tFirst name\tLast name\tTime\tLap 1\tLap 2\tLap 3\tHandicap"
HEAD_OLD = "Bib\tName\tTime\tLap.1\tLap.2\tLap.3"


def export(root, season, date, course, head, lines, bom=True):
    folder = root / "exports" / season / date / course
    folder.mkdir(parents=True)
    text = ("﻿" if bom else "") + "\r\n".join([head, *lines]) + "\r\n"
    (folder / "race one.txt").write_text(text, encoding="utf-8")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("club")
    (root / "calendar.csv").write_text(
        "season,race_number,date_ymd,race_type,cancelled,scheduled,cancelled_reason,report_id\n"
        "2030-2031,1,28/9/2030,Standard,,,,17\n"
        "2030-2031,2,5/10/2030,Club Championships,,,,\n"
        "2030-2031,3,12/10/2030,Standard,TRUE,,COVID,\n"
        "2030-2031,4,19/10/2030,Standard,,FALSE,New Years,\n"
    )
    export(
        root, "2030-2031", "2030-09-28", "full", HEAD_FULL,
        [
            "1\t1\tANN O'NEIL\tAnn\tO'Neil\t52:40.0\t8:25.0\t26:05.0\t18:10.0\t",
            "2\t2\tbo mcrae\tBo\tMcRae\t53:40.0\t9:25.0\t26:05.0\t18:10.0\t",
            "3\t3\tCy Dee\tCy\tDee\t53:40.0\t9:25.0\t26:05.0\t18:10.0\t",
            "-\t4\tDi Gone\tDi\tGone\tDNS\t\t\t\t",
            "-\t5\tEd Half\tEd\tHalf\tDNF\t9:00.0\t26:00.0\t-\t",
        ],
    )
    export(
        root, "2030-2031", "2030-10-05", "champ", HEAD_OLD,
        ["1\tann o'neil\t50:00.0\t8:00.0\t25:00.0\t17:00.0"], bom=False,
    )
    export(
        root, "2030-2031", "2030-10-05", "full", HEAD_FULL,
        [
            "1\t2\tBo Mcrae\tBo\tMcRae\t55:00.0\t8:00.0\t25:00.0\t17:00.0\t+5:00.0",
            "2\t3\tCy Dee\tCy\tDee\t45:00.0\t0:30.0\t25:00.0\t17:00.0\t-1:00.0",
        ],
    )
    export(root, "2030-2031", "2030-10-05", "aqua", HEAD_OLD, ["9\tNo Body\t1:00.0\t1:00.0\t-\t-"])
    calendar = readers.expanded_calendar(readers.read_calendar(spark, str(root / "calendar.csv")))
    results = readers.read_results(spark, str(root / "exports"), calendar)
    return root, calendar, results


@pytest.fixture(scope="module")
def facts(loaded, spark):
    _, _, results = loaded
    wide = results.withColumns(
        {
            "race_ref": F.concat(F.lit("r-"), F.col("date_ymd").cast("string")),
            "race_link": F.col("date_ymd").cast("string"),
            "participation_only": F.lit(False),
        }
    )
    ids = [
        "season", "race_number", "date_ymd", "race_type", "course", "is_champ", "bib", "name",
        "place_import", "time_overall_import", "handicap_import", "started", "participation_only",
        "race_ref", "race_link",
    ]
    aliases = spark.createDataFrame([("cy dee", "CYRIL dee")], "name_in string, name_out string")
    problems = spark.createDataFrame(
        [(dt.date(2030, 9, 28), "Bo McRae", "Swim", False, True)] * 2,
        "date_ymd date, name string, part string, split_valid boolean, cumulative_valid boolean",
    )
    return build_facts(long_results(wide, ids), aliases, problems).cache()


def one(df, **where):
    for column, value in where.items():
        df = df.filter(F.col(column) == value)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_headings_are_bound_by_file(loaded):
    rows = loaded[2]
    assert rows.count() == 8  # the aqua folder is in no calendar row
    champ = one(rows, is_champ=True)
    assert (champ["course"], champ["name"], champ["Swim"], champ["handicap"]) == (
        "full", "ann o'neil", "8:00.0", None,
    )


def test_names_and_starts(facts):
    names = {r["name"] for r in facts.select("name").distinct().collect()}
    assert names == {"Ann O'Neil", "Bo McRae", "Cyril Dee", "Ed Half"}


def test_ties_follow_the_name(facts):
    first = facts.filter("race_number = 1 and part = 'Run'")
    assert one(first, name="Bo McRae")["place_overall"] == 3
    assert one(first, name="Cyril Dee")["place_overall"] == 4


def test_invalid_leg_comes_last_and_is_not_shown(facts):
    row = one(facts.filter("race_number = 1 and part = 'Swim'"), name="Bo McRae")
    assert row["split_valid"] is False and row["place_leg_nice"] == "NA"
    assert row["place_leg"] == 4 and row["display_class"] == "Swim (invalid)"


def test_unfinished_effort_counts_missing_leg_as_zero(facts):
    row = one(facts.filter("part = 'Run'"), name="Ed Half")
    assert row["duration_seconds"] == 0.0 and row["overall_seconds"] == 2100.0


def test_handicap_is_added_only_where_the_leg_stays_positive(facts):
    second = facts.filter("race_number = 2 and part = 'Swim'")
    bo = one(second, name="Bo McRae")
    assert bo["duration_seconds"] == 780.0 and bo["duration_seconds_original"] == 480.0
    cy = one(second, name="Cyril Dee")
    assert cy["handicap_valid"] is False and cy["duration_seconds"] == 30.0
    # sum and record differ by more than a second: the sum is trusted
    assert cy["total_resolve"] == "cumulative" and cy["overall_seconds"] == 2550.0


def test_new_best_needs_an_earlier_race(facts):
    ann = facts.filter(F.col("name") == "Ann O'Neil")
    assert not one(ann.filter("race_number = 1 and part = 'Swim'"))["new_pb_leg"]
    row = one(ann.filter("race_number = 2 and part = 'Swim'"))
    assert row["new_pb_leg"] and row["season_pb_leg"] and row["new_pb_overall"]


def test_records_and_reports(facts):
    table = reports.record_table_overall(facts, "2030-2031", "full").collect()
    assert [r["record_rank_overall"] for r in table] == sorted(r["record_rank_overall"] for r in table)
    race = reports.race_table(facts, "2030-2031", 1, "full").collect()
    assert [r["name"] for r in race] == ["Ed Half", "Ann O'Neil", "Bo McRae", "Cyril Dee"]
    board = reports.season_leaderboard(facts).collect()
    assert {r["name"]: r["entries_total"] for r in board}["Ann O'Neil"] == 2


IDS = [
    "season", "race_number", "date_ymd", "race_type", "course", "is_champ", "bib", "name",
    "place_import", "time_overall_import", "handicap_import", "started", "participation_only",
]


@pytest.fixture
def two_rows_per_task(spark):
    spark.conf.set("spark.lapledger.groupRows", "2")
    yield
    spark.conf.unset("spark.lapledger.groupRows")


def test_hot_records_equal_plain_records(loaded, spark, two_rows_per_task):
    """With a limit of two rows every course is cut into blocks."""
    long = long_results(loaded[2].withColumn("participation_only", F.lit(False)), IDS)
    plain = build_facts(long, hot=[False, False, False])
    blocks = build_facts(long, hot=[False, False, True])
    assert sorted(blocks.columns) == sorted(plain.columns)
    assert blocks.select(plain.columns).exceptAll(plain).isEmpty()
    assert blocks.count() == plain.count()


def test_hot_efforts_equal_plain_efforts(loaded, spark, two_rows_per_task):
    """With a limit of two rows every effort is cut into blocks."""
    long = long_results(loaded[2].withColumn("participation_only", F.lit(False)), IDS)
    parsed = parsed_results(cleaned_results(long))
    plain, blocks = timed_results(parsed, hot=False), timed_results(parsed, hot=True)
    assert blocks.select(plain.columns).exceptAll(plain).isEmpty()
    assert blocks.count() == plain.count()


def test_checks(facts, spark):
    assert checks.check_unique_effort(facts).isEmpty()
    assert checks.check_totals_resolved(facts).isEmpty()
    percent = spark.createDataFrame([("5%",), ("+1:00.0",)], "handicap_import string")
    assert checks.check_no_percent(percent).count() == 1
    with pytest.raises(ValueError):
        checks.require_none(checks.check_no_percent(percent), "percent")


def test_dupes_lose_the_double_course(spark):
    day = dt.date(2020, 1, 1)
    rows = spark.createDataFrame(
        [("A", "Swim", day, "double"), ("A", "Swim", day, "full"), ("B", "Swim", day, "double")],
        "name string, part string, date_ymd date, course string",
    )
    kept = reconcile.drop_cross_course_dupes(rows, rows.select("date_ymd"))
    assert {(r["name"], r["course"]) for r in kept.collect()} == {("A", "full"), ("B", "double")}
    none = rows.select("date_ymd").limit(0)
    assert reconcile.drop_cross_course_dupes(rows, none).count() == 3


def test_snapshot_is_partitioned_and_pruned(facts, spark, tmp_path):
    path = str(tmp_path / "facts")
    writers.save_snapshot(facts, path)
    back = writers.load_snapshot(spark, path)
    assert back.count() == facts.count()
    assert (tmp_path / "facts" / "season=2030-2031").exists()


def test_lookups_meet_the_rows_where_they_lie(loaded, spark):
    """The rows are dealt out by effort and by name once each, also when no lookup is small enough to send around."""
    long = long_results(loaded[2].withColumn("participation_only", F.lit(False)), IDS)
    problems = spark.createDataFrame(
        [(dt.date(2030, 9, 28), "Bo McRae", part, split, True) for part, split in (("Swim", False), ("Run", True), (None, False))],
        "date_ymd date, name string, part string, split_valid boolean, cumulative_valid boolean",
    )
    overrides = problems.select("date_ymd", "name", F.lit("int").alias("course"))
    dates, known = problems.select("date_ymd").limit(0), problems.select("name", F.lit(1).alias("entries_before"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = build_facts(
            long, None, problems, overrides, dates, dates, dates, known, known.select("name"), hot=[False] * 3
        )
        cleaned = cleaned_results(
            long, None, problems, overrides, dates, dates, False, lambda df: spread.dealt(df, None, "date_ymd", "name")
        )
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # rows, problems and overrides
    by_name = [keys for keys in dealt if "name#" in keys]
    assert len(by_name) == 3 and not any("part#" in keys for keys in by_name)
    rows = facts.filter("name = 'Bo McRae' and date_ymd = date'2030-09-28'").collect()
    assert {(r.part, r.course, r.split_valid, r.entries_before) for r in rows} == {
        ("Swim", "int", False, 0), ("Ride", "int", True, 0), ("Run", "int", True, 0)
    }


def test_dealt_rows_are_placed_and_written_alike(facts, spark, tmp_path):
    ranked = ("place_leg", "place_cumulative", "place_overall", "record_rank_overall", "record_rank_leg")
    placed = placed_results(facts.drop(*ranked), rows=facts.count())
    columns = ["name", "part", "date_ymd", "course", *ranked]
    assert placed.select(columns).exceptAll(facts.select(columns)).isEmpty()
    assert placed.count() == facts.count()
    path = str(tmp_path / "dealt")
    writers.save_snapshot(placed, path, dealt=True)
    assert writers.load_snapshot(spark, path).select(columns).exceptAll(facts.select(columns)).isEmpty()


def test_task_counts_grow_with_the_rows(spark):
    assert spread.task_count(spark, 0, 100) == 1
    assert spread.task_count(spark, 100_000, 100) == 1000
    rows = spark.range(10).withColumn("k", F.col("id") % 3)
    assert spread.group_sizes(rows, [("k",), ("id", "k")]) == (10, [4, 1])


def test_handicap_looks_for_hot_efforts_once(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("A", dt.date(2030, 1, 1), part, 60.0, 180.0, "+0:30.0", True, "", "") for part in ("Swim", "Ride", "Run")],
        "name string, date_ymd date, part string, duration_seconds double, overall_seconds double,"
        "handicap_import string, started boolean, duration_hms string, overall_hms string",
    )
    looks, look = [], spread.any_hot
    monkeypatch.setattr(spread, "any_hot", lambda *args: looks.append(args) or look(*args))
    moved = reconcile.apply_handicap(rows)
    assert len(looks) == 1
    assert {(r.part, r.duration_seconds, r.overall_seconds) for r in moved.collect()} == {
        ("Swim", 90.0, 210.0), ("Ride", 60.0, 210.0), ("Run", 60.0, 210.0)
    }


def test_steps_on_an_effort_share_their_sorts(spark):
    """One sort serves double entries and both lookups, another both passes over the times."""
    rows = spark.createDataFrame(
        [],
        "name string, date_ymd date, part string, course string, duration_import string, time_overall_import string,"
        "handicap_import string, started boolean",
    )
    problems = spark.createDataFrame(
        [], "date_ymd date, name string, part string, split_valid boolean, cumulative_valid boolean"
    )
    days = problems.select("date_ymd")
    overrides = problems.select("date_ymd", "name", F.lit("int").alias("course"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = cleaned_results(
            rows, None, problems, overrides, None, days, False, lambda df: spread.dealt(df, 4, "name", "date_ymd")
        )
        plan = timed_results(parsed_results(cleaned))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = [line.split("Sort [")[1].split("]")[0] for line in plan.splitlines() if "Sort [" in line]
    sorts = [" ".join(key.split("#")[0] for key in keys.split(", ")) for keys in sorts]
    assert plan.count("SortMergeJoin") == 2
    # the lookups, one of them by leg too, and the rows twice
    rows_sorted = [keys for keys in sorts if keys.endswith(" part") or "__leg" in keys]
    assert rows_sorted.count("name date_ymd __leg") == 1 and "name date_ymd part" in rows_sorted
    assert len(sorts) <= 5


def test_packed_efforts_are_cleaned_as_their_legs_are(loaded, spark):
    """Double entries and overrides are found on whole efforts, and give what they give leg by leg."""
    wide = loaded[2].withColumn("participation_only", F.lit(False))
    wide = wide.unionByName(wide.filter("race_number = 1").withColumn("course", F.lit("double")))
    day = dt.date(2030, 9, 28)
    problems = spark.createDataFrame(
        [(day, "Bo McRae", part, split, True) for part, split in (("Swim", False), ("Run", True), (None, False))],
        "date_ymd date, name string, part string, split_valid boolean, cumulative_valid boolean",
    )
    overrides = spark.createDataFrame([(day, "Ed Half", "int")], "date_ymd date, name string, course string")
    aliases = spark.createDataFrame([("cy dee", "CYRIL dee")], "name_in string, name_out string")
    lookups = (aliases, problems, overrides, problems.select("date_ymd"), problems.select("date_ymd"), False)
    legs = cleaned_results(long_results(wide, IDS), *lookups)
    packed = cleaned_results(long_results(wide, IDS, legs_packed), *lookups)
    assert packed.select(legs.columns).exceptAll(legs).isEmpty()
    assert packed.count() == legs.count() == 21  # the double course is gone
    assert one(packed, name="Ed Half", part="Run")["course"] == "int"
    assert not one(packed.filter("race_number = 1"), name="Bo McRae", part="Swim")["split_valid"]


def test_packed_efforts_are_counted_by_leg(loaded):
    wide = loaded[2].withColumn("participation_only", F.lit(False))
    legs, packed = long_results(wide, IDS), long_results(wide, IDS, legs_packed)
    assert batch_sizes(packed) == batch_sizes(legs) == (21, [6, 4, 7])


def test_time_texts_become_seconds_without_lists(spark):
    texts = ["1:02:03.5", "9:25.0", "52:40.0", "-", "DNF", "", "1:2:3:4", "1:02:03.5 ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", time_seconds(F.col("t")).alias("s"))
    assert [r.s for r in rows.collect()] == [3723.5, 565.0, 3160.0, None, None, None, None, None, None]
    assert "split" not in rows._jdf.queryExecution().optimizedPlan().toString()
