"""Running bests, personal bests, season bests and the labels made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.model import LEGS, OWN

OWN_EFFORT = ("name", "season", "course", "race_number")
IN_ORDER = ("date_ymd", "is_champ", "race_number")
# measure → (minutes, validity flag)
MEASURES = {
    "leg": ("duration_mins", "split_valid"),
    "cumulative": ("cumulative_mins", "cumulative_valid"),
    "overall": ("overall_mins", "overall_valid"),
}


def running_best(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    partition: Sequence[str] = OWN,
    order: Sequence[str] = IN_ORDER,
    hot: bool | None = None,
) -> DataFrame:
    """New column → (value, flag): the best valid value so far, null on invalid rows."""
    steps = {to: spread.lowest(F.when(F.col(f), F.col(v))) for to, (v, f) in columns.items()}
    best = spread.running(df, partition, [F.col(c) for c in order], steps, hot)
    return best.withColumns({to: F.when(F.col(f), F.col(to)) for to, (_, f) in columns.items()})


def running_best_leg(df: DataFrame, **more) -> DataFrame:
    return running_best(df, {"running_best_leg": MEASURES["leg"]}, **more)


def running_best_cumulative(df: DataFrame, **more) -> DataFrame:
    return running_best(df, {"running_best_cumulative": MEASURES["cumulative"]}, **more)


def running_best_overall(df: DataFrame, **more) -> DataFrame:
    """An overall time stands on each leg row, so the legs are kept apart here too."""
    return running_best(df, {"running_best_overall": MEASURES["overall"]}, **more)


def _equals(value: Column, best: Column) -> Column:
    return F.coalesce(value == best, F.lit(False))


def new_pb(df: DataFrame, to: str, value: str, best: str, first: str = "first_race") -> DataFrame:
    """Equal to the running best and not the first race of the season."""
    held = _equals(F.col(value), F.col(best)) & ~F.coalesce(F.col(first), F.lit(False))
    return df.withColumn(to, held)


def new_pbs(df: DataFrame) -> DataFrame:
    """new_pb_leg, new_pb_cumulative and new_pb_overall from the running bests."""
    for measure, (value, _) in MEASURES.items():
        df = new_pb(df, f"new_pb_{measure}", value, f"running_best_{measure}")
    return df


def season_pb(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    partition: Sequence[str] = OWN,
    hot: bool | None = None,
) -> DataFrame:
    """New column → (value, flag): is the value the best valid one of the season?"""
    lows = {f"__{to}": F.min(F.when(F.col(f), F.col(v))) for to, (v, f) in columns.items()}
    found = spread.group_values(df, partition, lows, hot)
    flags = {
        to: F.coalesce(F.col(f) & _equals(F.col(v), F.col(f"__{to}")), F.lit(False))
        for to, (v, f) in columns.items()
    }
    return found.withColumns(flags).drop(*lows)


def season_pbs(df: DataFrame, partition: Sequence[str] = OWN, hot: bool | None = None) -> DataFrame:
    """season_pb_leg, season_pb_cumulative and season_pb_overall."""
    return season_pb(df, {f"season_pb_{m}": c for m, c in MEASURES.items()}, partition, hot)


def all_bests(
    df: DataFrame,
    partition: Sequence[str] = OWN,
    order: Sequence[str] = IN_ORDER,
    hot: bool | None = None,
) -> DataFrame:
    """Running bests, new and season bests of all measures in one pass over the competitor's efforts."""
    steps = {}
    for measure, (value, valid) in MEASURES.items():
        counted = F.when(F.col(valid), F.col(value))
        steps[f"running_best_{measure}"] = spread.lowest(counted)
        steps[f"__low_{measure}"] = spread.lowest(counted, whole=True)
    found = spread.running(df, partition, [F.col(c) for c in order], steps, hot)
    flags = {}
    for measure, (value, valid) in MEASURES.items():
        best = F.when(F.col(valid), F.col(f"running_best_{measure}"))
        low = F.when(F.col(valid), F.col(f"__low_{measure}"))
        again = ~F.coalesce(F.col("first_race"), F.lit(False))
        flags[f"running_best_{measure}"] = best
        flags[f"new_pb_{measure}"] = _equals(F.col(value), best) & again
        flags[f"season_pb_{measure}"] = _equals(F.col(value), low)
    return found.withColumns(flags).drop(*[f"__low_{m}" for m in MEASURES])


def effort_has_pb(
    df: DataFrame,
    partition: Sequence[str] = OWN_EFFORT,
    best: str = "season_pb_leg",
    hot: bool | None = None,
) -> DataFrame:
    """Is any leg of this effort a season best? Null where the competitor did not start."""
    any_leg = F.bool_or(F.when(F.col("started"), F.col(best)))
    found = spread.group_values(df, partition, {"effort_has_pb": any_leg}, hot)
    return found.withColumn("effort_has_pb", F.when(F.col("started"), F.col("effort_has_pb")))


# The label endings in their display order.
CLASS_ENDINGS = ("", " (PB)", " (record)", " (invalid)")


def display_class(df: DataFrame) -> DataFrame:
    """Leg label with "(invalid)", "(record)" or "(PB)", the stronger one winning, and its order."""
    part = F.col("part")
    record = F.coalesce(F.col("record_rank_leg") == 1, F.lit(False))
    pb = F.coalesce(F.col("season_pb_leg") & (F.col("record_rank_leg") != 1), F.lit(False))
    invalid = ~F.coalesce(F.col("split_valid"), F.lit(True))

    def named(ending: str) -> Column:
        return F.concat(part, F.lit(ending))

    label = F.when(record, named(" (record)")).when(invalid, named(" (invalid)")).otherwise(part)
    with_pb = F.when(pb, named(" (PB)")).otherwise(label)
    levels = F.array(*[F.lit(leg + ending) for ending in CLASS_ENDINGS for leg in LEGS])
    return df.withColumns({"display_class": label, "display_class_pb": with_pb}).withColumn(
        "display_order", F.array_position(levels, F.col("display_class_pb")).cast("int")
    )
