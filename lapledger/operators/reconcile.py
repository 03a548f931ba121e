"""Times of one effort brought into agreement: handicap, running sum, recorded total.

An effort is a competitor on a date, three rows. Everything here works on that key, so one exchange
serves all of it; ``hot`` says whether a key with very many rows exists (see ``lapledger.spread``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.functions.times import handicap_seconds, seconds_hms
from lapledger.model import EFFORT, FIRST_LEG, LAST_LEG, leg_order
from lapledger.operators.update import when_all


def drop_cross_course_dupes(
    df: DataFrame,
    dates: DataFrame,
    keys: Sequence[str] = (*EFFORT, "part"),
    course: str = "double",
    hot: bool | None = None,
) -> DataFrame:
    """On the listed dates a competitor found in several courses loses the rows of ``course``.

    The keys begin like those of the lookups that follow, which so find the rows sorted.
    """
    listed = dates.select("date_ymd").distinct().withColumn("__listed", F.lit(True))
    # dates of races are few however many rows there are
    joined = df.join(F.broadcast(listed), "date_ymd", "left")
    counted = spread.group_values(joined, keys, {"__n": F.count(F.lit(1))}, hot)
    dupe = when_all(F.col("__listed"), F.col("__n") > 1, F.col("course") == course)
    return counted.filter(~dupe).select(*df.columns)


def overall_validity(
    df: DataFrame, effort: Sequence[str] = EFFORT, hot: bool | None = None
) -> DataFrame:
    """The overall time is valid when the cumulative time at the last leg is."""
    at_end = F.max(F.when(F.col("part") == LAST_LEG, F.col("cumulative_valid")))
    found = spread.group_values(df, effort, {"overall_valid": at_end}, hot)
    return found.withColumn("overall_valid", F.coalesce("overall_valid", F.lit(True)))


def cumulative_time(
    df: DataFrame,
    effort: Sequence[str] = EFFORT,
    value: str = "duration_seconds",
    to: str = "cumulative_seconds",
    hot: bool | None = None,
) -> DataFrame:
    """Running sum of the legs in race order."""
    order = [leg_order(F.col("part"))]
    return spread.running(df, effort, order, {to: spread.total(F.col(value))}, hot)


def apply_handicap(
    df: DataFrame, effort: Sequence[str] = EFFORT, hot: bool | None = None
) -> DataFrame:
    """Add the handicap to the first leg where that leg stays above zero.

    Adds cumulative_seconds; efforts with a handicap take their overall time from it, keep the first
    leg's own time in duration_seconds_original and get their time texts rendered again.
    """
    if hot is None:
        # all steps share the key, so one look does for all; later ones would repeat the steps before them
        hot = spread.any_hot(df, effort)
    first = F.col("part") == FIRST_LEG
    size = F.when(F.col("started"), handicap_seconds(F.col("handicap_import")))
    sized = df.withColumn("handicap_seconds", size)
    usable = when_all(first, F.col("handicap_seconds") + F.col("duration_seconds") > 0)
    flagged = spread.group_values(sized, effort, {"handicap_valid": F.bool_or(usable)}, hot)
    moved = F.col("handicap_valid") & first
    changed = flagged.withColumn(
        "duration_seconds_original", F.when(moved, F.col("duration_seconds"))
    ).withColumn(
        "duration_seconds",
        F.when(moved, F.col("duration_seconds") + F.col("handicap_seconds")).otherwise(
            F.col("duration_seconds")
        ),
    )
    summed = cumulative_time(changed, effort, hot=hot)
    finish = F.max(F.when(F.col("part") == LAST_LEG, F.col("cumulative_seconds")))
    ended = spread.group_values(summed, effort, {"__finish": finish}, hot)
    handicapped = F.col("handicap_valid")
    overall = F.when(handicapped, F.col("__finish")).otherwise(F.col("overall_seconds"))
    texts = {
        "duration_hms": F.when(handicapped, seconds_hms(F.col("duration_seconds"))).otherwise(
            F.col("duration_hms")
        ),
        "overall_hms": F.when(handicapped, seconds_hms(F.col("overall_seconds"))).otherwise(
            F.col("overall_hms")
        ),
    }
    return ended.withColumn("overall_seconds", overall).withColumns(texts).drop("__finish")


def reconcile_totals(
    df: DataFrame,
    effort: Sequence[str] = EFFORT,
    tolerance: float = 1.0,
    hot: bool | None = None,
) -> DataFrame:
    """Where sum and recorded total differ by more than ``tolerance`` seconds, one replaces the other.

    The sum is trusted when its last leg is valid, else the recorded total. Adds total_disagree,
    total_resolve ("cumulative" or "imported") and total_resolved.
    """
    last = F.col("part") == LAST_LEG
    gap = F.abs(F.col("cumulative_seconds") - F.col("overall_seconds")) > tolerance
    found = spread.group_values(
        df,
        effort,
        {
            "total_disagree": F.bool_or(when_all(last, gap)),
            "__finish": F.max(F.when(last, F.col("cumulative_seconds"))),
            "__valid": F.max(F.when(last, F.col("cumulative_valid"))),
        },
        hot,
    )
    choice = F.when(F.col("__valid"), F.lit("cumulative")).otherwise(F.lit("imported"))
    marked = found.withColumn("total_resolve", F.when(F.col("total_disagree"), choice))
    summed = F.coalesce(F.col("total_resolve") == "cumulative", F.lit(False))
    recorded = F.coalesce(F.col("total_resolve") == "imported", F.lit(False))
    return marked.withColumns(
        {
            "overall_seconds": F.when(summed, F.col("__finish")).otherwise(
                F.col("overall_seconds")
            ),
            "cumulative_seconds": F.when(recorded & last, F.col("overall_seconds")).otherwise(
                F.col("cumulative_seconds")
            ),
            "total_resolved": F.when(F.col("total_disagree"), summed | recorded),
        }
    ).drop("__finish", "__valid")


def fill_missing_overall(
    df: DataFrame, effort: Sequence[str] = EFFORT, hot: bool | None = None
) -> DataFrame:
    """Started efforts without an overall time take their largest cumulative time."""
    largest = spread.group_values(df, effort, {"__most": F.max("cumulative_seconds")}, hot)
    filled = F.when(
        F.col("started"), F.coalesce(F.col("overall_seconds"), F.col("__most"))
    ).otherwise(F.col("overall_seconds"))
    return largest.withColumn("overall_seconds", filled).drop("__most")


def final_cumulative(df: DataFrame) -> DataFrame:
    """The cumulative time at the last leg is the overall time (minutes are taken before this)."""
    at_end = F.when(F.col("part") == LAST_LEG, F.col("overall_seconds"))
    return df.withColumn(
        "cumulative_seconds", at_end.otherwise(F.col("cumulative_seconds"))
    )


def settled_times(
    df: DataFrame,
    effort: Sequence[str] = EFFORT,
    tolerance: float = 1.0,
    hot: bool | None = None,
) -> DataFrame:
    """Handicap, running sum, reconciled and filled totals in two passes over each effort.

    Gives what apply_handicap, reconcile_totals, fill_missing_overall and overall_validity give one
    after the other: the recorded total is the same on all rows of an effort, so once the sum at the
    finish is known on every row the rest is arithmetic. Both passes share one sort.
    """
    first, last = F.col("part") == FIRST_LEG, F.col("part") == LAST_LEG
    # a column of its own: an expression would be another one, and sorted by again, in the second pass
    df = df.withColumn("__leg", leg_order(F.col("part")))
    order = [F.col("__leg")]
    size = F.col("handicap_seconds")
    usable = when_all(F.col("started"), first, size + F.col("duration_seconds") > 0)
    flagged = spread.running(
        df,
        effort,
        order,
        {
            "handicap_valid": spread.highest(usable, whole=True),
            "overall_valid": spread.highest(F.when(last, F.col("cumulative_valid")), whole=True),
        },
        hot,
    )
    moved = F.col("handicap_valid") & first
    changed = flagged.withColumns(
        {
            "overall_valid": F.coalesce("overall_valid", F.lit(True)),
            "duration_seconds_original": F.when(moved, F.col("duration_seconds")),
            "duration_seconds": F.col("duration_seconds") + F.when(moved, size).otherwise(0.0),
        }
    )
    value = F.col("duration_seconds")
    summed = spread.running(
        changed,
        effort,
        order,
        {
            "cumulative_seconds": spread.total(value),
            "__finish": spread.total(value, whole=True),
        },
        hot,
    )
    finish = F.col("__finish")
    recorded = F.when(F.col("handicap_valid"), finish).otherwise(F.col("overall_seconds"))
    told = summed.withColumn("overall_seconds", recorded)
    gap = F.coalesce(F.abs(finish - F.col("overall_seconds")) > tolerance, F.lit(False))
    marked = told.withColumn("total_disagree", gap)
    choice = F.when(F.col("overall_valid"), "cumulative").otherwise("imported")
    chosen = marked.withColumn("total_resolve", F.when(F.col("total_disagree"), choice))
    trusted = F.coalesce(F.col("total_resolve") == "imported", F.lit(False))
    # without a recorded total the sum at the finish is the largest one, unless the legs are negative
    overall = F.when(trusted, F.col("overall_seconds")).when(F.col("total_disagree"), finish)
    missing = F.when(F.col("started"), finish)
    return chosen.withColumns(
        {
            "cumulative_seconds": F.when(trusted & last, F.col("overall_seconds")).otherwise(
                F.col("cumulative_seconds")
            ),
            "overall_seconds": overall.otherwise(F.coalesce("overall_seconds", missing)),
            "total_resolved": F.when(F.col("total_disagree"), F.lit(True)),
        }
    ).drop("__finish", "__leg")
