"""Event rows -> modelling table, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar as cal
from ..operators import lookup, panel as p, spatial, temporal
from ..operators.demographics import population_join
from ..session import cut_lineage


def month_counts(events: DataFrame, location: str, date_col: str) -> DataFrame:
    """Events per location and month as a written table.

    The only pass over the event table. All later stages (calendar bounds, month
    axis, grid) read this small result, and a lost executor costs no second pass.
    """
    return cut_lineage(events.groupBy(location, date_col).agg(F.count("*").alias("_events")))


def base_panel(events: DataFrame, location: str, target: str, date_col: str = "Month",
               calendar: bool = False) -> DataFrame:
    """Dense panel with calendar columns and the holiday flag."""
    counts = p.normalize_time(month_counts(events, location, date_col), date_col)
    grid = p.densify_grid(counts, location, target, weight="_events", calendar=calendar)
    return grid.withColumn("holiday_month", cal.holiday_month(F.col("month")))


def build_features(events: DataFrame, *, location: str = "loc", target: str = "count",
                   date_col: str = "Month", population: DataFrame | None = None,
                   snapshots: DataFrame | None = None, housing: DataFrame | None = None,
                   edges: DataFrame | None = None, classes: DataFrame | None = None,
                   class_key: str | None = None, neighbor_prefix: str | None = None,
                   calendar: bool = False) -> DataFrame:
    """The modelling table.

    Order of the stages: neighbour features need every location, so they come first,
    while the panel has five columns; the residential filter follows, because no
    later feature looks across locations; then the window features, after the one
    shuffle by location; last the dimensions, which join on the location alone and so
    keep that partitioning. Wide rows are never shuffled.
    """
    panel = base_panel(events, location, target, date_col, calendar)
    years = panel.select("year").distinct()
    if edges is not None:
        panel = spatial.add_neighbor_features(panel, edges, location, target,
                                              neighbor_prefix or f"neighbor_{target}")
    if snapshots is not None:
        # Months before the first snapshot are not part of any series.
        panel = panel.filter(F.col("year") >= snapshots.select(F.min("valid_from")).scalar())
    if classes is not None:
        panel = lookup.semi_filter(panel, location, classes, class_key or location)
    panel = temporal.add_temporal_features(panel, location, target, risk=True)
    if population is not None:
        panel = population_join(panel, population, location, panel_years=years)
    if snapshots is not None:
        panel = lookup.snapshot_join(panel, snapshots, location)
    if housing is not None:
        panel = lookup.dimension_join(panel, housing, location)
    return panel
