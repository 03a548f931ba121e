"""Readers on small files: the last line of a key counts, the first headings of a file bind, seasons are replaced alone."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapledger.driver import views
from lapledger.operators import joins, update
from lapledger.plans import snapshot
from lapledger.session import new_path, settle
from lapledger.sources import readers

SF_DIR = "/root/testdata/sf0.001"


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


def test_the_last_line_of_a_key_counts(spark, tmp_path):
    head = "date_ymd,name,part,split_valid,cumulative_valid"
    rows = ["1/9/2030,Bo Day,Swim,TRUE,TRUE", "1/9/2030,Bo Day,Swim,FALSE,TRUE", "1/9/2030,Al Day,Swim,FALSE,FALSE", "1/9/2030,Al Day,Swim,TRUE,FALSE"]
    efforts = spark.createDataFrame([(dt.date(2030, 9, 1), n, "Swim") for n in ("Bo Day", "Al Day", "Cy Day")], "date_ymd date, name string, part string")
    for order, expected in ((rows, {"Bo Day": (False, True), "Al Day": (True, False)}), (rows[::-1], {"Bo Day": (True, True), "Al Day": (False, False)})):
        listed = readers.read_timing_problems(spark, lines(tmp_path / "problems.csv", head, *order))
        spark.catalog.clearCache()
        found = {r["name"]: (r.split_valid, r.cumulative_valid) for r in joins.attach_problems(efforts, listed).collect()}
        assert found == expected | {"Cy Day": (True, True)}


def test_the_last_alias_and_override_count(spark, tmp_path):
    names = readers.read_aliases(spark, lines(tmp_path / "aliases.csv", "name_in,name_out,other", "bo day,ZOE Day,", "BO DAY,Amy Day,"))
    rows = spark.createDataFrame([("Bo Day", "full")], "name string, course string")
    assert joins.apply_aliases(rows, names).first()["name"] == "Amy Day"
    path = lines(tmp_path / "overrides.csv", "date_ymd,name,course", "1/9/2030,Bo Day,teams", "1/9/2030,Bo Day,int")
    dated = rows.withColumn("date_ymd", F.lit(dt.date(2030, 9, 1)))
    fixed = update.apply_overrides(dated, readers.read_overrides(spark, path), ["date_ymd", "name"], ["course"])
    assert fixed.first()["course"] == "int" and fixed.columns == dated.columns


def test_lines_count_in_the_order_of_their_files(spark, tmp_path):
    folder = tmp_path / "lists"
    folder.mkdir()
    for name, course in (("b.csv", "full"), ("a.csv", "teams"), ("c.csv", "int")):
        lines(folder / name, "date_ymd,name,course", f"1/9/2030,Bo Day,{course}", "1/9/2030,Al Day,full")
    listed = readers.read_overrides(spark, str(folder))
    assert joins.last_match(listed, ["date_ymd", "name"]).filter("name = 'Bo Day'").first()["course"] == "int"


def test_without_positions_the_largest_row_counts(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "c"), (1, "a"), (2, None)], "k int, v string")
    assert {r.k: r.v for r in joins.last_match(rows, ["k"]).collect()} == {1: "c", 2: None}


def test_headings_that_repeat(spark, tmp_path):
    folder = tmp_path / "exports" / "2030-2031" / "2030-09-28" / "full"
    folder.mkdir(parents=True)
    lines(
        folder / "race.txt", "﻿Bib\tName\tTime\tLap 1", "1\tAnn\t50:00.0\t8:00.0", "Name\tBib\tTime\tLap 1", "2\tBo\t51:00.0\t9:00.0",
        *[f"{i}\tEntrant {i}\t52:00.0\t9:30.0" for i in range(3, 4_000)],
    )
    calendar = spark.createDataFrame(
        [("2030-2031", dt.date(2030, 9, 28), "full", False, 1, "Standard")],
        "season string, date_ymd date, course string, is_champ boolean, race_number int, race_type string",
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "10000"):  # the file in one block, and in many
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.read_results(spark, str(tmp_path / "exports"), calendar)
            assert rows.count() == 3_999
            assert {(r.bib, r["name"]) for r in rows.filter("bib in ('1', '2', '3999')").collect()} == {("1", "Ann"), ("2", "Bo"), ("3999", "Entrant 3999")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture(scope="module")
def wide(spark):
    return settle(views.wide_seconds(spark, SF_DIR))


def test_a_season_is_replaced_alone(spark, wide):
    path = new_path(spark, "seasons")
    snapshot.save_seasons(views.facts(spark, SF_DIR, wide), path)
    place = F.concat_ws("|", "season", F.element_at(F.split("_metadata.file_path", "/"), -1))

    def files(table):
        read = spark.read.parquet(f"{path}/{table}")
        return {r[0] for r in read.select(place).distinct().collect()}

    before = {t: files(t) for t in ("facts", "shares")}
    season = sorted(r[0] for r in wide.select("season").distinct().collect())[2]
    corrected = wide.filter(F.col("season") == season).filter("o_custkey % 5 != 0")
    snapshot.save_seasons(views.facts(spark, SF_DIR, corrected), path)
    for table, old in before.items():
        changed = {x.split("|")[0] for x in old ^ files(table)}
        assert changed == {season}
    whole = views.facts(spark, SF_DIR, wide.filter((F.col("season") != season) | (F.col("o_custkey") % 5 != 0)))
    columns = ["name", "date_ymd", "part", "course", "place_overall", "entries_total", *snapshot.CAREER]
    loaded = snapshot.load_seasons(spark, path)
    assert set(loaded.columns) == set(whole.columns)
    assert loaded.select(*columns).exceptAll(whole.select(*columns)).count() == 0
    assert whole.select(*columns).exceptAll(loaded.select(*columns)).count() == 0
