"""Data-quality checks: each returns the rows that break the rule, none when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.model import EFFORT, FIRST_LEG


def require_none(violations: DataFrame, message: str) -> None:
    """Stop a job when a check found anything."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{message}: {[row.asDict() for row in found]}")


def check_unique_effort(facts: DataFrame, keys: Sequence[str] = EFFORT) -> DataFrame:
    """Competitors with more than one entry on a date."""
    entries = facts.filter(F.col("part") == FIRST_LEG)
    return entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries")).filter("entries > 1")


def check_no_percent(df: DataFrame, handicap: str = "handicap_import") -> DataFrame:
    """Rows whose handicap column holds a percentage, a sign of shifted columns."""
    return df.filter(F.col(handicap).contains("%"))


def check_totals_resolved(facts: DataFrame) -> DataFrame:
    """Disagreeing totals that were not resolved."""
    return facts.filter(F.col("total_disagree") & ~F.coalesce("total_resolved", F.lit(False)))


def check_unknown_names(
    facts: DataFrame, history: DataFrame, confirmed: DataFrame | None = None
) -> DataFrame:
    """Competitors found neither in the history nor among the confirmed newcomers.

    One row per name and bib with the races of the name, so no list of bibs is gathered in one place.
    """
    entries = facts.filter(F.col("part") == FIRST_LEG).withColumn("__key", F.lower("name"))
    known = history.select(F.lower("name").alias("__key"))
    if confirmed is not None:
        known = known.unionByName(confirmed.select(F.lower("name").alias("__key")))
    unknown = entries.join(known.distinct(), "__key", "left_anti")
    bibs = unknown.groupBy("name", "bib").agg(
        F.count(F.when(F.col("started"), True)).alias("races_bib")
    )
    races = bibs.groupBy("name").agg(F.sum("races_bib").alias("races"))
    return bibs.join(races, "name").select("name", "bib", "races_bib", "races")


def check_repeated_bib(df: DataFrame, bib: str = "bib", name: str = "name") -> DataFrame:
    """Bibs given out more than once, with the names that hold them."""
    assigned = df.filter(F.col(bib).isNotNull())
    repeated = assigned.groupBy(bib).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    return assigned.join(repeated, bib).select(bib, name, "times")
