"""Expressions for places, sentences, seasons and tooltips."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_text(place: Column, missing: str = "NA") -> Column:
    """1st, 2nd, 3rd, 4th …; 11 to 13 of every hundred take "th"."""
    last, teens = place % 10, (place % 100).between(11, 13)
    ending = (
        F.when(teens, "th")
        .when(last == 1, "st")
        .when(last == 2, "nd")
        .when(last == 3, "rd")
        .otherwise("th")
    )
    shown = F.concat(place.cast("string"), ending)
    return F.when(place.isNull() | (place == 0), F.lit(missing)).otherwise(shown)


def and_list(parts: Column) -> Column:
    """["a"] → "a", ["a","b"] → "a and b", ["a","b","c"] → "a, b, and c"."""
    count = F.size(parts)
    leading = F.array_join(F.slice(parts, 1, F.greatest(count - 1, F.lit(0))), ", ")
    last = F.try_element_at(parts, F.lit(-1))
    return (
        F.when(count == 0, F.lit(""))
        .when(count == 1, last)
        .when(count == 2, F.concat(leading, F.lit(" and "), last))
        .otherwise(F.concat(leading, F.lit(", and "), last))
    )


def separator_after(index: Column, count: Column, per_column: int = 20) -> Column:
    """What follows the index-th (from 1) of ``count`` names laid out in about 20 lines.

    Up to ``per_column`` - 1 names stand one per line; more names share the lines.
    """
    columns = F.floor(count / per_column) + 1
    ends_line = (columns == 1) | (index % columns == 0)
    return F.when(index == count, "").when(ends_line, "\n").otherwise(", ")


def name_block(names: Column, per_column: int = 20) -> Column:
    """An array of names as one text of about 20 lines."""
    marked = F.transform(
        names,
        lambda name, i: F.concat(name, separator_after(i + 1, F.size(names), per_column)),
    )
    return F.array_join(marked, "")


def season_text(header: Column) -> Column:
    """"'98-99" → "1998-1999"; two-digit years from 69 on are in the last century."""

    def year(start: int) -> Column:
        two = F.substring(digits, start, 2).try_cast("int")
        return F.when(two >= 69, two + 1900).otherwise(two + 2000).cast("string")

    digits = F.regexp_replace(header, "^'", "")
    return F.concat(year(1), F.lit("-"), year(4))


def counted(count: Column, one: str, many: str) -> Column:
    return F.concat_ws(" ", count.cast("string"), F.when(count == 1, one).otherwise(many))
