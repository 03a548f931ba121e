"""Expressions between time texts and seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HMS = r"^(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)$"


def padded_time(text: Column) -> Column:
    """"M:SS.s" and "MM:SS.s" get their missing hour; anything else stays."""
    return (
        F.when(F.length(text) == 6, F.concat(F.lit("0:0"), text))
        .when(F.length(text) == 7, F.concat(F.lit("0:"), text))
        .otherwise(text)
    )


def hms_seconds(text: Column) -> Column:
    """H:MM:SS.s → seconds; DNF, DSQ, "-", blanks and other texts → null."""

    hours, minutes, seconds = (
        part.try_cast("double")
        for part in (
            F.substring_index(text, ":", 1),
            F.substring_index(F.substring_index(text, ":", 2), ":", -1),
            F.substring_index(text, ":", -1),
        )
    )
    return F.when(text.rlike(HMS), hours * 3600 + minutes * 60 + seconds)


def time_seconds(text: Column) -> Column:
    return hms_seconds(padded_time(text))


def handicap_seconds(text: Column) -> Column:
    """A sign and a time: "-1:30.0" → -90."""
    size = time_seconds(F.substr(text, F.lit(2)))
    return F.when(F.substring(text, 1, 1) == "-", -size).otherwise(size)


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _clock(second: Column, hour_digits: int) -> list[Column]:
    hour = F.floor(second / 3600)
    shown = _two(hour) if hour_digits == 2 else hour.cast("string")
    colon = F.lit(":")
    return [shown, colon, _two(F.floor(second / 60) % 60), colon, _two(second % 60)]


def seconds_hms(seconds: Column, rounding: str = "no", tenths: bool = True) -> Column:
    """HH:MM:SS.s, or HH:MM:SS when ``tenths`` is False.

    ``rounding`` is applied to whole seconds: no, round, ceiling or floor. Tenths are rounded half
    up on the whole time, so 59.96 s is one minute and never "60.0". Without tenths and with
    "no" rounding the fraction is cut off.
    """
    whole = {
        "no": seconds if tenths else F.floor(seconds),
        "round": F.floor(seconds + 0.5),
        "ceiling": F.ceil(seconds),
        "floor": F.floor(seconds),
    }[rounding]
    if not tenths:
        return F.concat(*_clock(whole.cast("long"), 2))
    count = F.floor(whole * 10 + 0.5)
    return F.concat(*_clock(F.floor(count / 10), 2), F.lit("."), (count % 10).cast("string"))


def seconds_short(seconds: Column, keep_hour: bool = False) -> Column:
    """H:MM:SS.s with the leading "0:" left out unless ``keep_hour``."""
    count = F.floor(seconds * 10 + 0.5)
    text = F.concat(*_clock(F.floor(count / 10), 1), F.lit("."), (count % 10).cast("string"))
    if keep_hour:
        return text
    return F.when(count < 36000, F.substr(text, F.lit(3))).otherwise(text)


def unpadded_time(text: Column) -> Column:
    """An 8-character time loses one leading zero."""
    return F.when(
        (F.length(text) == 8) & text.startswith("0"), F.substring(text, 2, 7)
    ).otherwise(text)
