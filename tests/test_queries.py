"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as driver
from lapledger.driver.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert differences(df, con, driver.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1


def test_overall_bests_are_counted_and_told(spark):
    rows = driver.queries()["race_pb_headline"](spark, SF_DIR).filter("new_pb_overall > 0").collect()
    assert rows and all(f"{r.new_pb_overall} new overall PBs" in r.sentence for r in rows)


def test_the_batch_holds_rows_of_every_source(spark):
    """Exports, team sheets, lists, and races with double entries and with the time of day, each with rows."""
    from lapledger.driver import views
    from pyspark.sql import functions as F

    wide = views.wide_seconds(spark, SF_DIR)
    rows = views.batch_rows(spark, SF_DIR, wide)
    before = {r.entry_source: r.n for r in rows.groupBy("entry_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(before) == {"export", "teams", "listed"} and min(before.values()) > 0
    facts = views.facts(spark, SF_DIR)
    after = {r.entry_source: r.n for r in facts.groupBy("entry_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    # only double entries go
    assert (after["teams"], after["listed"]) == (before["teams"], before["listed"]) and after["export"] < before["export"]
    per_day = facts.filter("part = 'Run'").groupBy("name", "date_ymd").count()
    assert per_day.filter("count > 1").count() == 0
    clock = facts.filter("dayofmonth(date_ymd) = 5 and entry_source = 'export'").select("name", "date_ymd", "part", "duration_seconds")
    raw = views.raw_results(spark, SF_DIR, wide, F.dayofmonth("date_ymd") == 5).filter("dayofmonth(date_ymd) = 5")
    assert clock.count() and raw.filter("time like '7:%'").count()


def test_listed_rows_take_part_only(spark):
    rows = driver.queries()["batch_facts"](spark, SF_DIR).filter("entry_source != 'export'")
    assert rows.count() and rows.filter("split_valid or cumulative_valid or overall_valid").count() == 0
    assert {r[0] for r in rows.select("overall_seconds").distinct().collect()} == {3600.0}
