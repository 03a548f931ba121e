"""The fact table kept season by season, so that a new race rewrites its own season only.

All but a few facts belong to one season: places, records, bests, running entries and totals of the season. What
spans a career (entries so far and in all, the last entry of all) is kept apart, as each season's share of it: a
row per competitor, leg and season. Reading adds the shares of the earlier seasons. So a season can be added, or
written again after a correction, in any order, and what is read equals one run over all seasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapledger import spread
from lapledger.model import FULL_AND_DOUBLE
from lapledger.session import SMALL, new_path, remove, wide_rows_written

SEASON, SHARE = ("name", "part", "season"), ("name", "part")
#: Facts of the whole career, made when the snapshot is read.
CAREER = (
    "entries_cumulative_all",
    "entries_cumulative_all_fd",
    "entries_total_all",
    "entries_total_all_fd",
    "is_last_entry_all",
)


def career_shares(facts: DataFrame) -> DataFrame:
    """``name, part, season`` with the season's entries, those on full and double courses, and its last date."""
    started = F.coalesce("started", F.lit(False)).cast("long")
    long_course = F.col("course").isin(*FULL_AND_DOUBLE).cast("long")
    return facts.groupBy(*SEASON).agg(
        F.sum(started).alias("entries"), F.sum(long_course).alias("entries_fd"), F.max("date_ymd").alias("last_date")
    )


def _replace(df: DataFrame, path: str) -> None:
    """Write the seasons that ``df`` has rows of, and no other."""
    with wide_rows_written(df.sparkSession):
        df.write.options(**SMALL).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "season"
        ).parquet(path)


def save_seasons(facts: DataFrame, path: str, settled: bool = False) -> None:
    """Add or replace the seasons in ``facts``, the result of the batch over the rows of whole seasons.

    The career facts are left out: a batch over some seasons cannot know them. A reader between the two writes
    sees the season's rows with its old share. Facts that are ``settled``, read from where they were written, are
    written into the folders of their seasons from where they lie; others are written once before that, so that
    both tables are made from the same rows. Labels need not be saved: ``labelled_results`` makes them of what is read.
    """
    spark = facts.sparkSession
    rows, once = facts.drop(*CAREER), None
    if not settled:
        once = new_path(spark, "season")
        rows.write.parquet(once)
        rows = spark.read.parquet(once)
    _replace(rows if settled else rows.hint("rebalance", "season"), f"{path}/facts")
    _replace(career_shares(rows).hint("rebalance", "season"), f"{path}/shares")
    if once is not None:
        remove(spark, once)


def load_seasons(spark: SparkSession, path: str, hot: bool | None = None) -> DataFrame:
    """All seasons, with the career facts as one run over all of them gives them."""
    facts = spark.read.parquet(f"{path}/facts")
    shares = spark.read.parquet(f"{path}/shares")
    steps = {
        "upto": spread.total(F.col("entries")),
        "upto_fd": spread.total(F.col("entries_fd")),
        "all": spread.total(F.col("entries"), whole=True),
        "all_fd": spread.total(F.col("entries_fd"), whole=True),
        "last": spread.highest(F.col("last_date"), whole=True),
    }
    career = spread.running(shares, SHARE, [F.col("season")], {f"__{k}": v for k, v in steps.items()}, hot)
    career = career.withColumns(
        {"__upto": F.col("__upto") - F.col("entries"), "__upto_fd": F.col("__upto_fd") - F.col("entries_fd")}
    ).drop("entries", "entries_fd", "last_date")
    joined = spread.attach(facts, career, SEASON, "inner")
    before = F.col("entries_before")
    made = {
        "entries_cumulative_all": F.col("__upto") + F.col("entries_cumulative") + before,
        "entries_cumulative_all_fd": F.col("__upto_fd") + F.col("entries_cumulative_fd") + before,
        "entries_total_all": F.col("__all") + before,
        "entries_total_all_fd": F.col("__all_fd") + before,
        "is_last_entry_all": F.col("date_ymd") == F.col("__last"),
    }
    return joined.withColumns(made).drop(*[c for c in career.columns if c.startswith("__")])
