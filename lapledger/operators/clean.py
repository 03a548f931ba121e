"""Cleaning and formatting jobs: built-in expressions applied to named columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapledger.functions import names, texts, times


def clean_names(
    df: DataFrame, name: str = "name", reverse: bool = False, split: bool = True
) -> DataFrame:
    """Standard capitals, optionally from "LAST First" order, with first and last name and page link."""
    text = names.reversed_name(F.col(name)) if reverse else F.col(name)
    cleaned = df.withColumn(name, names.standard_name(text))
    return split_names(cleaned, name) if split else cleaned


def split_names(df: DataFrame, name: str = "name") -> DataFrame:
    column = F.col(name)
    parts = df.withColumns(
        {
            "name_first": names.first_name(column),
            "name_last": names.last_name(column),
            "athlete_ref": names.page_ref(column),
        }
    )
    return parts.withColumn("athlete_link", names.page_link(F.col("athlete_ref"), column))


def parse_times(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New column → time text: the seconds of each text, null where it is no time."""
    return df.withColumns({to: times.time_seconds(F.col(c)) for to, c in columns.items()})


def parse_handicaps(df: DataFrame, handicap: str = "handicap_import") -> DataFrame:
    return df.withColumn("handicap_seconds", times.handicap_seconds(F.col(handicap)))


def render_times(
    df: DataFrame, columns: dict[str, str], rounding: str = "no", tenths: bool = True
) -> DataFrame:
    """New column → seconds: HH:MM:SS.s texts."""
    return df.withColumns(
        {to: times.seconds_hms(F.col(c), rounding, tenths) for to, c in columns.items()}
    )


def render_short_times(df: DataFrame, columns: dict[str, str], keep_hour: bool = False) -> DataFrame:
    return df.withColumns(
        {to: times.seconds_short(F.col(c), keep_hour) for to, c in columns.items()}
    )


def render_places(df: DataFrame, columns: dict[str, str], missing: str = "NA") -> DataFrame:
    return df.withColumns({to: texts.place_text(F.col(c), missing) for to, c in columns.items()})


def render_sentences(df: DataFrame, parts: str, to: str = "sentence") -> DataFrame:
    """An array column as "a, b, and c"."""
    return df.withColumn(to, texts.and_list(F.col(parts)))


def tooltip_names(
    df: DataFrame, names_column: str, to: str = "names_text", per_column: int = 20
) -> DataFrame:
    """An array of names laid out in about 20 lines."""
    return df.withColumn(to, texts.name_block(F.col(names_column), per_column))


def recode_seasons(df: DataFrame, season: str = "season") -> DataFrame:
    return df.withColumn(season, texts.season_text(F.col(season)))
