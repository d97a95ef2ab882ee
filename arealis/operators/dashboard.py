"""Dashboard look-ups on the long tables: key filters that reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def list_areas(areas: DataFrame, level: str, lad=None, ward=None) -> DataFrame:
    """Codes and names of the boroughs, the wards of a borough or the areas of a
    ward, sorted by name; without a parent code, those of every parent."""
    if level not in ("lad", "ward", "loc"):
        raise ValueError("level must be lad, ward or loc")
    if lad is not None:
        areas = areas.filter(F.col("lad") == lad)
    if ward is not None:
        areas = areas.filter(F.col("ward") == ward)
    parents = {"lad": [], "ward": ["lad"], "loc": ["lad", "ward"]}[level]
    return areas.select(*parents, F.col(level).alias("code"), F.col(f"{level}_name").alias("name")
                        ).distinct().orderBy("name", "code")


def lookup_series(long: DataFrame, location: str, code=None) -> DataFrame:
    """Series of one location; an unknown code gives no rows."""
    return long if code is None else long.filter(F.col(location) == code)


def points_in_range(points: DataFrame, month: str, start: str | None = None, end: str | None = None,
                    location: str | None = None, code=None) -> DataFrame:
    """Points of a location with their month in [start, end]; all if a bound is missing."""
    if code is not None:
        points = points.filter(F.col(location) == code)
    if start is None or end is None:
        return points
    return points.filter(F.col(month).between(start, end))


def months_with_data(points: DataFrame, location: str, month: str, code=None) -> DataFrame:
    if code is not None:
        points = points.filter(F.col(location) == code)
    return points.select(location, month, F.substring(month, 1, 4).alias("year")).distinct().orderBy(
        location, month)


def area_flags(areas: DataFrame, predictions: DataFrame, officers: DataFrame, points: DataFrame,
               location: str = "loc") -> DataFrame:
    """Whether each area has predictions, officers and points."""
    def marked(df: DataFrame, name: str) -> DataFrame:
        return df.select(location).distinct().withColumn(name, F.lit(True))

    names = ["has_predictions", "has_officers", "has_points"]
    out = areas
    for df, name in zip((predictions, officers, points), names):
        out = out.join(marked(df, name), location, "left")
    return out.fillna(False, subset=names)


def merged_timeline(history: DataFrame, predictions: DataFrame, location: str, month: str,
                    start: str | None = None, end: str | None = None) -> DataFrame:
    """History rows then prediction rows of every location that has predictions.

    ``prediction_start`` is the first prediction month where both sides have rows.
    """
    known = history.join(predictions.select(location).distinct(), location, "left_semi")
    rows = known.select(location, month, F.col("historical"), F.lit(None).cast("double").alias("prediction"),
                        F.lit(0).alias("_side")).unionByName(
        predictions.select(location, month, F.lit(None).cast("bigint").alias("historical"),
                           F.col("prediction"), F.lit(1).alias("_side")))
    rows = points_in_range(rows, month, start, end)
    one = Window.partitionBy(location)
    first = F.min(F.when(F.col("_side") == 1, F.col(month))).over(one)
    both = F.min("_side").over(one) < F.max("_side").over(one)
    return (rows.withColumn("prediction_start", F.when(both, first))
            .orderBy(location, "_side", month).drop("_side"))


def officers_by_hour(roster: DataFrame, location: str, month: str, hourly: str = "hourly",
                     code=None, month_key: str | None = None) -> DataFrame:
    """24 values per location and month; arrays of any other length are rejected."""
    if code is not None:
        roster = roster.filter(F.col(location) == code)
    if month_key is not None:
        roster = roster.filter(F.col(month) == month_key)
    return roster.filter(F.size(hourly) == 24).select(
        location, month, F.posexplode(hourly).alias("hour", "officers"))
