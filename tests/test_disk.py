"""What the batch and its reports leave on disk, and what they need not write there."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from lapledger import session
from lapledger.driver import views
from lapledger.driver.queries import QUERIES
from lapledger.plans import facts as plans_facts
from lapledger.plans import replay, reports
from lapledger.session import settle, shared_folder

SF_DIR = "/root/testdata/sf0.001"


def shared(spark):
    return set(Path(shared_folder(spark).removeprefix("file:")).iterdir())


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(disk.getAllFiles().mkString("\n").split("\n"))


def test_settled_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = settle(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert rows.count() == 7
    for _ in range(40):
        left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.25)
    assert len(left) <= 1  # that of the count


def test_saving_facts_keeps_the_facts_only(spark):
    views._SAVED.pop((spark.sparkContext.applicationId, SF_DIR), None)
    before = shared(spark)
    facts = views.saved_facts(spark, SF_DIR)
    assert {p.name.split("-")[0] for p in shared(spark) - before} == {"facts"}
    assert facts.count() == 3990


def test_replay_frames_are_not_sorted(spark):
    rows = [
        ("1996-1997", 1, "full", False, "1996-01-01", name, part, True, "x", last, "N", leg * 10.0 + k, (k + leg) % 2 + 1)
        for k, (name, last) in enumerate((("N A", "A"), ("N B", "B")))
        for leg, part in enumerate(("Swim", "Ride", "Run"), 1)
    ]
    names = "season race_number course is_champ date_ymd name part started display_class name_last name_first cumulative_mins place_cumulative"
    frames = replay.race_replay(spark.createDataFrame(rows, names.split()), hot=False)
    assert "lag(" not in frames._jdf.queryExecution().optimizedPlan().toString()
    told = {(r.name, r.part, r.stage): (r.place, r.place_diff, r.change_type, r.change_text) for r in frames.collect()}
    assert len(told) == 42
    # by surname first, then by the place at each leg; changes from stage 4, shown at 5 and 7
    assert [told["N A", "Run", s][0] for s in range(1, 8)] == [1, 1, 2, 2, 1, 1, 2]
    assert [told["N A", "Run", s][1] for s in range(1, 8)] == [None, None, None, 1, -1, -1, 1]
    assert told["N A", "Run", 5][2:] == ("up", "↑ 1") and told["N A", "Run", 7][2:] == ("down", "↓ 1")
    assert told["N A", "Run", 6][2:] == (None, None)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_saved_facts_lie_by_name(spark):
    """Reports on efforts and competitors deal no rows out; a race's rows still have to come together."""
    facts = views.saved_facts(spark, SF_DIR)
    for report in (reports.race_table, reports.athlete_table, reports.athlete_course_table, reports.record_table_overall):
        assert exchanges(report(facts)) == 0
    assert exchanges(reports.record_table_leg(facts, "Run")) == 0
    assert exchanges(facts.groupBy("season", "race_number").count()) == 1
    files = Path(shared_folder(spark).removeprefix("file:")).glob("facts-*/season=1996-1997")
    assert any(files)  # one folder per season


def test_whole_rows_are_not_dealt_out_for_their_ranks(spark, monkeypatch):
    """What the ranks meet is read from its buckets; only keys and numbers are shuffled after the rows are written."""
    plans, save = [], session.save_buckets

    def saved(df, *args, **more):
        plans.append(exchanges(df))
        return save(df, *args, **more)

    monkeypatch.setattr(session, "save_buckets", saved)
    monkeypatch.setattr(plans_facts, "save_buckets", saved)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(session.ALL_KEYS, "false")
    try:
        views.facts(spark, SF_DIR, until="places")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset(session.ALL_KEYS)
    # rows, three kinds of ranks, and the rows with their ranks
    assert len(plans) == 5 and plans[4] == 0


def test_rows_without_a_name_are_placed(spark):
    flags = {flag: F.lit(True) for flag in (*plans_facts.FLAGS, "started", "is_champ", "season_pb_overall", "season_pb_leg")}
    rows = [(None, 30.0), ("A", 20.0), (None, 10.0)]
    facts = spark.createDataFrame(rows, "name string, duration_mins double").withColumns(
        flags
        | {"season": F.lit("2030-2031"), "race_number": F.lit(1), "course": F.lit("full"), "part": F.lit("Swim")}
        | {"date_ymd": F.lit("2030-09-28").cast("date")}
        | {m: F.col("duration_mins") for m in plans_facts.MEASURES}
    )
    placed = plans_facts.placed_results(facts, rows=1_000_000)
    assert {(r.name, r.duration_mins, r.place_leg, r.place_overall, r.record_rank_leg) for r in placed.collect()} == {
        (None, 10.0, 1, 1, 1), ("A", 20.0, 2, 2, 2), (None, 30.0, 3, 3, 3)
    }


def test_only_the_columns_asked_for_are_placed_and_written(spark, monkeypatch):
    names, saved, save = ("name", "date_ymd", "part", "record_rank_leg"), [], plans_facts.save_buckets
    monkeypatch.setattr(plans_facts, "save_buckets", lambda df, *args: saved.append(df.columns) or save(df, *args))
    placed = views.facts(spark, SF_DIR, until="places", columns=names)
    assert saved == [list(names)]
    whole = views.saved_facts(spark, SF_DIR).select(*names)
    assert placed.exceptAll(whole).isEmpty() and placed.count() == whole.count()


def test_timed_efforts_are_read_from_where_they_were_written(spark):
    plan = QUERIES["timed_efforts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_large_competitors_are_placed_without_buckets(spark, tmp_path):
    ranked = ("place_leg", "place_cumulative", "place_overall", "record_rank_overall", "record_rank_leg")
    names = ("name", "date_ymd", "part", "course", *ranked)
    facts = views.saved_facts(spark, SF_DIR)
    path = f"{tmp_path}/facts"
    for placed in (
        plans_facts.placed_results(facts.drop(*ranked), hot_name=True, rows=400_000, into=path),
        plans_facts.placed_results(facts.drop(*ranked), hot_name=True),
    ):
        assert placed.select(*names).exceptAll(facts.select(*names)).isEmpty() and placed.count() == facts.count()
    assert (tmp_path / "facts" / "season=1996-1997").exists()


def test_legs_are_dealt_out_packed_and_inputs_go_when_read(spark, monkeypatch):
    """The rows dealt out by name are efforts, written small once aliases are joined; none of it waits for the places."""
    seen, settled = [], plans_facts.settle

    def watched(df, *args):
        if args:
            seen.append({p.name for p in shared(spark)})
        elif "entry_source" in df.columns:
            assert "legs" in df.columns and "part" not in df.columns
            seen.append(df.columns)
        kept = settled(df, *args)
        if args:
            seen.append({p.name for p in shared(spark)})
        return kept

    monkeypatch.setattr(plans_facts, "settle", watched)
    before = {p.name for p in shared(spark)}
    facts = views.facts(spark, SF_DIR, until="places")
    # efforts, then what is there before and after the rows and each of three ranks are written
    assert len(seen) == 9 and facts.count() == 3990
    efforts_and_rows, rows, rows_later = seen[1] - before, seen[2] - before, seen[3] - before
    assert len(efforts_and_rows) == 2  # the efforts as made and as corrected
    assert rows_later == rows - efforts_and_rows and len(rows_later) == 1


def test_settled_tables_are_small(spark):
    path = settle(spark.range(10)).inputFiles()[0]
    assert path.endswith(".zstd.parquet")


def test_only_keys_and_numbers_pass_the_sorts_of_a_competitor(spark, monkeypatch):
    """Whole rows are written once their times are settled; counts, own ranks and bests are made beside them."""
    plans, save = [], session.save_buckets

    def saved(df, *args, **more):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return save(df, *args, **more)

    monkeypatch.setattr(session, "save_buckets", saved)
    monkeypatch.setattr(plans_facts, "save_buckets", saved)
    facts = views.facts(spark, SF_DIR, until="places")
    (rows, rows_plan), (own, own_plan) = plans[:2]
    assert "race_ref" in rows and "effort_rank_leg" not in rows and "row_number" not in rows_plan
    assert "effort_rank_leg" in own and "effort_has_pb" in own
    assert "race_ref" not in own_plan and "bib" not in own_plan
    whole = views.saved_facts(spark, SF_DIR).select(facts.columns)
    assert facts.exceptAll(whole).isEmpty() and facts.count() == whole.count()


def test_competitors_without_a_name_are_counted_together(spark):
    flags = {flag: F.lit(True) for flag in (*plans_facts.FLAGS, "started", "is_champ")}
    rows = spark.createDataFrame([(None, 1, 30.0), ("A", 1, 20.0), (None, 2, 10.0), ("", 1, 5.0)], "name string, race_number int, duration_mins double")
    rows = rows.withColumns(
        flags
        | {"season": F.lit("2030-2031"), "course": F.lit("full"), "part": F.lit("Swim")}
        | {"date_ymd": F.date_add(F.lit("2030-09-28").cast("date"), F.col("race_number"))}
        | {m: F.col("duration_mins") for m in plans_facts.MEASURES}
    )

    def own(facts):
        return plans_facts.best_results(plans_facts.counted_results(facts))

    for hot_name in (False, True):
        placed = plans_facts.placed_results(rows, hot_name=hot_name, rows=1_000_000, own=own)
        assert {(r.name, r.race_number, r.entries_cumulative, r.effort_rank_leg, r.record_rank_leg) for r in placed.collect()} == {
            (None, 1, 1, 2, None), (None, 2, 2, 1, 2), ("A", 1, 1, 1, 3), ("", 1, 1, 1, 1)
        }



def test_added_seasons_are_written_once_and_without_labels(spark):
    before = shared(spark)
    rows = QUERIES["add_season"](spark, SF_DIR)
    made = shared(spark) - before
    assert {p.name.split("-")[0] for p in made} == {"seasons"}
    saved = spark.read.parquet(f"{made.pop()}/facts")
    assert "place_leg" in saved.columns and "place_leg_nice" not in saved.columns
    assert rows.count() == saved.count() == 3990


def test_whole_rows_pass_one_join_when_they_meet_their_ranks(spark, monkeypatch):
    joins, save = [], plans_facts.save_buckets

    def saved(df, *args):
        node = df._jdf.queryExecution().optimizedPlan()
        nodes = [node]
        while nodes:
            node = nodes.pop()
            below = [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Join":
                joins.append(node.output().size())
            nodes += below
        return save(df, *args)

    monkeypatch.setattr(plans_facts, "save_buckets", saved)
    width = len(views.facts(spark, SF_DIR, until="places").columns)
    assert len(joins) == 3 and sum(size >= width for size in joins) == 1
