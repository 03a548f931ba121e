"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapledger.session import shuffles_removed


def write_start_list(starts: DataFrame, path: str) -> None:
    """Entrant, chip, course and start time as CSV."""
    starts.select(
        F.col("name").alias("Name"), "chip", "course", F.col("start_time").alias("Start time")
    ).write.csv(path, header=True)


def write_season_export(bests: DataFrame, path: str, form: str = "csv") -> None:
    """Season bests for other programs, as CSV or Parquet."""
    writer = bests.write
    writer.csv(path, header=True) if form == "csv" else writer.parquet(path)


def save_snapshot(
    df: DataFrame, path: str, partition: str | None = "season", mode: str = "errorifexists", dealt: bool = False
) -> None:
    """A derived table for later jobs, one folder per season.

    The rebalance hint lets adaptive execution split large seasons and join small ones into files of
    even size. Rows that lie by season in tasks of even size (``dealt``) are written from where they are.
    """
    keys = [] if partition is None else [partition]
    rows = df if dealt else df.hint("rebalance", *keys)
    with shuffles_removed(df.sparkSession):
        rows.write.mode(mode).partitionBy(*keys).parquet(path)


def load_snapshot(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
