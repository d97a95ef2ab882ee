"""Forecast -> roster -> nested export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar as cal
from ..operators import allocate, tree
from ..session import cut_lineage
from ..sources import sinks


def keyed_predictions(forecast: DataFrame, location: str = "loc") -> DataFrame:
    """Forecast rows with a month key and a score."""
    return forecast.select(F.col(location).alias("loc"), cal.month_key(F.col("year"), F.col("month"))
                           .alias("month_key"), F.col("prediction").alias("score"))


def daily_roster(areas: DataFrame, predictions: DataFrame, months: Sequence[str] | DataFrame) -> DataFrame:
    """Roster of all target months at once."""
    return allocate.allocate_daily(allocate.score_grid(areas, predictions, months))


def integrated_tree(areas: DataFrame, predictions: DataFrame, history: DataFrame,
                    months: Sequence[str] | DataFrame,
                    profile: allocate.HourProfile | None = None) -> DataFrame:
    """Nested tree with predictions, history and officer assignments of every area.

    The hours are filled in where the roster is gathered, in as many tasks as they need.
    """
    daily = cut_lineage(daily_roster(areas, predictions, months))
    tasks = tree.content_tasks(daily, 24 * daily.count())
    roster = allocate.allocate_hourly_remainder(
        daily.repartition(tasks, "loc"), profile or allocate.hour_profile())
    full = tree.integrate_all(
        areas, tree.month_map(predictions, "loc", "month_key", "score", "predictions"), history, roster)
    return tree.nest_hierarchy(full, ["predictions", "historical", "officer_assignments"])


def export_rosters(roster: DataFrame, profile: allocate.HourProfile, daily_path: str,
                   hourly_path: str) -> None:
    """Daily and hourly roster files with the documented headers."""
    named = roster.select(
        F.col("lad").alias("borough_code"), F.col("lad_name").alias("borough_name"),
        F.col("ward").alias("ward_code"), F.col("ward_name"), F.col("loc").alias("lsoa_code"),
        F.col("loc_name").alias("lsoa_name"), F.col("score").alias("prediction_score"),
        F.col("officers_assigned"))
    sinks.write_csv(named, daily_path)
    hourly = allocate.allocate_hourly_bump(named, profile)
    sinks.write_csv(hourly.select(*[c for c in named.columns if c != "officers_assigned"],
                                  "hour_block", "officers_assigned"), hourly_path)
