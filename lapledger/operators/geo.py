"""Tracks and points of interest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapledger.operators.aggregates import track_extent

# Fixed value: metres per degree of latitude on the mean sphere.
METRES_PER_DEGREE = 111_195.0


def course_boxes(
    tracks: DataFrame, keys: Sequence[str] = ("course", "part"), buffer_m: float = 20.0
) -> DataFrame:
    """The box around each track widened by ``buffer_m`` on every side."""
    boxes = track_extent(tracks, keys)
    rows = F.lit(buffer_m / METRES_PER_DEGREE)
    furthest = F.greatest(F.abs("ymin"), F.abs("ymax"))
    columns = rows / F.cos(F.radians(furthest))
    return boxes.select(
        *keys,
        (F.col("xmin") - columns).alias("xmin"),
        (F.col("ymin") - rows).alias("ymin"),
        (F.col("xmax") + columns).alias("xmax"),
        (F.col("ymax") + rows).alias("ymax"),
    )


def pois_near_course(
    points: DataFrame,
    tracks: DataFrame,
    buffer_m: float = 20.0,
    keys: Sequence[str] = ("course", "part"),
    cell: float = 0.05,
) -> DataFrame:
    """Points inside the widened box of each track.

    Boxes are listed under every grid cell of ``cell`` degrees they touch and points under their own
    cell, so the join is on equal cells and a point meets only boxes nearby.
    """

    def bin_of(value: Column) -> Column:
        return F.floor(value / cell).cast("long")

    boxes = course_boxes(tracks, keys, buffer_m)
    tiles = boxes.withColumn(
        "__x", F.explode(F.sequence(bin_of(F.col("xmin")), bin_of(F.col("xmax"))))
    ).withColumn("__y", F.explode(F.sequence(bin_of(F.col("ymin")), bin_of(F.col("ymax")))))
    placed = points.withColumn("__x", bin_of(F.col("lon"))).withColumn("__y", bin_of(F.col("lat")))
    joined = placed.join(tiles, ["__x", "__y"])
    inside = F.col("lon").between(F.col("xmin"), F.col("xmax")) & F.col("lat").between(
        F.col("ymin"), F.col("ymax")
    )
    return joined.filter(inside).drop("__x", "__y", "xmin", "ymin", "xmax", "ymax")


# New names of the course distances.
DISTANCE_NAMES = {"full": "sprint", "int": "tempta"}


def rename_distances(shapes: DataFrame, distance: str = "distance") -> DataFrame:
    """Course distances under their new names."""
    renamed = F
    for old, new in DISTANCE_NAMES.items():
        renamed = renamed.when(F.col(distance) == old, new)
    return shapes.withColumn(distance, renamed.otherwise(F.col(distance)))
