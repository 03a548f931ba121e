"""The block way of ordered and grouped calculations gives the rows of the plain windows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapledger import spread

LIMIT = 50


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of all rows, another third has no key, the rest is spread out."""
    number = F.col("id")
    key = F.when(number % 3 == 0, "hot").when(number % 3 == 1, F.concat(F.lit("k"), number % 97))
    return spark.range(3000).select(
        key.alias("key"),
        number.alias("tie"),
        F.when(number % 11 != 0, (number * 7919) % 211).cast("double").alias("value"),
    )


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    names = sorted(a.columns)
    assert a.select(names).exceptAll(b.select(names)).isEmpty()
    assert b.select(names).exceptAll(a.select(names)).isEmpty()


def test_hot_keys_are_found(rows):
    assert spread.any_hot(rows, ["key"], LIMIT)
    assert not spread.any_hot(rows, ["key", "tie"], LIMIT)
    assert spread.hot_key_sets(rows, [("key",), ("key", "tie"), ("value", "key")], LIMIT) == [
        True,
        False,
        True,
    ]


def test_running_columns(rows):
    steps = {
        "place": spread.position(),
        "sum": spread.total(F.col("value")),
        "low": spread.lowest(F.col("value")),
        "high": spread.highest(F.col("value")),
        "all": spread.total(F.col("value"), whole=True),
        "least": spread.lowest(F.col("value"), whole=True),
    }
    order = [*spread.nulls_last("value"), F.col("tie")]
    plain = spread.running(rows, ["key"], order, steps, hot=False)
    blocks = spread.running(rows, ["key"], order, steps, limit=LIMIT)
    same(plain, blocks)


def largest_range(df, keys, order, limit):
    hot = spread.hot_groups(df, keys, limit)
    ranges = spread._in_ranges(df, hot, keys, order, limit)
    return ranges.groupBy(*keys, spread.BLOCK).count().agg(F.max("count")).first()[0]


def test_ranges_are_small(rows):
    assert largest_range(rows, ["key"], [*spread.nulls_last("value"), F.col("tie")], LIMIT) <= 2 * LIMIT


@pytest.mark.parametrize("distinct", [1, 3, 300])
def test_equal_sort_keys_are_dealt_out(spark, distinct):
    df = spark.range(30_000).select(F.lit("hot").alias("key"), (F.col("id") % distinct).alias("at"), "id")
    assert largest_range(df, ["key"], [F.col("at")], 1000) <= 2000
    steps = {"place": spread.position(), "sum": spread.total(F.lit(1))}
    placed = spread.running(df, ["key"], [F.col("at")], steps, limit=1000)
    assert placed.filter("place != sum").isEmpty()
    assert placed.select("place").distinct().count() == 30_000
    after = placed.groupBy("at").agg(F.min("place").alias("low"), F.max("place").alias("high")).orderBy("at").collect()
    assert all(a["high"] < b["low"] for a, b in zip(after, after[1:]))


def test_group_values(rows):
    columns = {"most": F.max("value"), "count": F.count("value"), "any": F.bool_or(F.col("value") > 209)}
    same(
        spread.group_values(rows, ["key"], columns, hot=False),
        spread.group_values(rows, ["key"], columns, limit=LIMIT),
    )


def test_shared_rank(rows):
    same(
        spread.shared_rank(rows, ["key"], "value", "rank", hot=False),
        spread.shared_rank(rows, ["key"], "value", "rank", hot=True, limit=LIMIT),
    )


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "a", "a", "b"]), st.integers(0, 4) | st.none()),
        min_size=1,
        max_size=60,
    )
)
def test_places_are_a_permutation(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "key string, value int, tie int")
    order = [*spread.nulls_last("value"), F.col("tie")]
    placed = spread.running(df, ["key"], order, {"place": spread.position()}, limit=5).collect()
    for key in {row["key"] for row in placed}:
        group = sorted((r for r in placed if r["key"] == key), key=lambda r: r["place"])
        assert [r["place"] for r in group] == list(range(1, len(group) + 1))
        expected = sorted(group, key=lambda r: (r["value"] is None, r["value"] or 0, r["tie"]))
        assert group == expected
