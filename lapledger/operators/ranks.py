"""Places and ranks. Ties are broken by name, date and leg, so every run gives the same places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.model import OWN, RACE, RECORD, TIES, ties


def place(
    df: DataFrame,
    to: str,
    value: str,
    valid: str,
    partition: Sequence[str],
    tie_keys: Sequence[str] = TIES,
    hot: bool | None = None,
) -> DataFrame:
    """Place by value among all rows of the partition; invalid rows come last."""
    sorted_by = F.when(F.col(valid), F.col(value))
    order = [*spread.nulls_last(sorted_by), *ties(*tie_keys)]
    return spread.running(df, partition, order, {to: spread.position()}, hot)


def place_leg(df: DataFrame, partition=RACE, value="duration_mins", valid="split_valid", **more):
    """Place by leg time."""
    return place(df, "place_leg", value, valid, partition, **more)


def place_cumulative(
    df: DataFrame, partition=RACE, value="cumulative_mins", valid="cumulative_valid", **more
):
    """Place by the time up to each leg."""
    return place(df, "place_cumulative", value, valid, partition, **more)


def place_overall(df: DataFrame, partition=RACE, value="overall_mins", valid="overall_valid", **more):
    """Place by overall time."""
    return place(df, "place_overall", value, valid, partition, **more)


def effort_rank_leg(df: DataFrame, partition=OWN, value="duration_mins", valid="split_valid", **more):
    """A competitor's own efforts of a season and course ranked by leg time."""
    return place(df, "effort_rank_leg", value, valid, partition, **more)


def effort_rank_cumulative(
    df: DataFrame, partition=OWN, value="cumulative_mins", valid="cumulative_valid", **more
):
    return place(df, "effort_rank_cumulative", value, valid, partition, **more)


def effort_rank_overall(
    df: DataFrame, partition=OWN, value="overall_mins", valid="overall_valid", **more
):
    return place(df, "effort_rank_overall", value, valid, partition, **more)


def _others_apart(among: Column, spread_by: Sequence[str]) -> Column:
    """A partition key that is null for rows taking part and scatters the others."""
    return F.when(~F.coalesce(among, F.lit(False)), F.xxhash64(*spread_by))


def _rank_among(
    df: DataFrame,
    to: str,
    value: str,
    among: Column,
    partition: Sequence[str],
    tie_keys: Sequence[str],
    hot: bool | None,
) -> DataFrame:
    if hot is None:
        hot = spread.any_hot(df.filter(among), partition)
    apart = df.withColumn("__apart", _others_apart(among, tie_keys))
    order = [*spread.nulls_last(value), *ties(*tie_keys)]
    ranked = spread.running(apart, [*partition, "__apart"], order, {to: spread.position()}, hot)
    return ranked.withColumn(to, F.when(F.col("__apart").isNull(), F.col(to))).drop("__apart")


def record_rank_overall(
    df: DataFrame,
    partition: Sequence[str] = RECORD,
    value: str = "overall_mins",
    best: str = "season_pb_overall",
    tie_keys: Sequence[str] = TIES,
    hot: bool | None = None,
) -> DataFrame:
    """Season bests ranked over all competitors of the course; other rows get null."""
    among = F.col("started") & F.col(best)
    return _rank_among(df, "record_rank_overall", value, among, partition, tie_keys, hot)


def record_rank_leg(
    df: DataFrame,
    partition: Sequence[str] = RECORD,
    value: str = "duration_mins",
    best: str = "season_pb_leg",
    tie_keys: Sequence[str] = TIES,
    hot: bool | None = None,
) -> DataFrame:
    """Season leg bests ranked over all competitors of the course; other rows get null."""
    among = F.col("started") & F.col(best)
    return _rank_among(df, "record_rank_leg", value, among, partition, tie_keys, hot)


def leaderboard_rank(
    df: DataFrame,
    partition: Sequence[str],
    total: str,
    to: str = "total_rank",
    hot: bool | None = None,
) -> DataFrame:
    """Rank of the total, largest first, equal totals sharing the smaller rank.

    The frame should hold one row per competitor and partition, as ``last_entry`` rows do.
    """
    return spread.shared_rank(df, partition, total, to, hot)


def alphabetic_place(
    df: DataFrame,
    partition: Sequence[str],
    to: str = "alphabetic_place",
    order: Sequence[str] = ("name_last", "name_first", "name"),
    hot: bool | None = None,
) -> DataFrame:
    """Initial order by surname and first name."""
    by = [key for name in order for key in spread.nulls_last(name)]
    return spread.running(df, partition, by, {to: spread.position()}, hot)


def place_change(
    df: DataFrame,
    partition: Sequence[str],
    stage: str = "stage",
    place: str = "place",
    back: int = 2,
    shown: Sequence[int] = (5, 7),
    since: int = 4,
    before: Column | None = None,
) -> DataFrame:
    """Place against the place two stages before, with direction and label on the shown stages.

    The partition is one competitor and leg of one race, so it holds one row per stage. Where a row itself tells
    the place ``back`` stages before, ``before`` gives it, and frames need not be sorted.
    """
    if before is None:
        before = F.lag(place, back).over(Window.partitionBy(*partition).orderBy(stage))
    diff = F.when(F.col(stage) >= since, F.col(place) - before)
    moved = df.withColumn("place_diff", diff)
    step, visible = F.col("place_diff"), F.col(stage).isin(*shown)
    return moved.withColumns(
        {
            "change_type": F.when(
                visible, F.when(step < 0, "up").when(step > 0, "down").when(step == 0, "equal")
            ),
            "change_text": F.when(
                visible,
                F.when(step < 0, F.concat(F.lit("↑ "), (-step).cast("string")))
                .when(step > 0, F.concat(F.lit("↓ "), step.cast("string")))
                .when(step == 0, "-"),
            ),
        }
    )
