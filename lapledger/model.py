"""Names shared by the operators: legs, courses, keys and order of the results fact table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The legs of a race in order, and the courses with their labels.
LEGS = ("Swim", "Ride", "Run")
FIRST_LEG, LAST_LEG = LEGS[0], LEGS[-1]
COURSE_LABELS = {
    "int": "Intermediate",
    "full": "Full",
    "double": "Double Distance",
    "teams": "Super Teams",
}
CHAMPIONSHIP = "Club Championships"
FULL_AND_DOUBLE = ("full", "double")

EFFORT = ("name", "date_ymd")
RACE = ("season", "race_number", "course", "part", "is_champ")
OWN = ("name", "season", "course", "part")
RECORD = ("course", "season", "part")
TIES = ("name", "date_ymd", "part")


def leg_order(part: Column) -> Column:
    """1, 2, 3 for the legs in race order."""
    return F.array_position(F.array(*[F.lit(leg) for leg in LEGS]), part).cast("int")


def course_order(label: Column) -> Column:
    """Order of the course labels: intermediate, full, double, teams."""
    labels = F.array(*[F.lit(text) for text in COURSE_LABELS.values()])
    return F.array_position(labels, label).cast("int")


def ties(*names: str) -> list[Column]:
    return [F.col(name) for name in (names or TIES)]
