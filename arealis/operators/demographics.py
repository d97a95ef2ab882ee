"""Wide yearly tables, extrapolation and land-use classes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def population_long(df: DataFrame, location: str, value_mark: str = "Population",
                    density_mark: str = "Sq Km", prefix: str = "Mid-") -> DataFrame:
    """Wide ``Mid-YYYY...`` columns -> one row per location and year.

    Both measures of a year are taken from the same input row, so pairing them
    needs no join: the row is exploded over the years that have both columns. The
    column names are metadata; no job runs.
    """
    def years(mark: str) -> dict[int, str]:
        return {int(re.search(r"\d{4}", c).group(0)): c for c in df.columns
                if prefix in c and mark in c}

    people, density = years(value_mark), years(density_mark)
    rows = [F.struct(F.lit(y).alias("year"), F.col(f"`{people[y]}`").alias("population"),
                     F.col(f"`{density[y]}`").alias("population_density"))
            for y in sorted(people.keys() & density.keys())]
    return df.select(location, F.explode(F.array(*rows)).alias("r")).select(location, "r.*")


def missing_years(panel: DataFrame, population: DataFrame, year: str = "year") -> DataFrame:
    """Years of the panel that the population table does not have."""
    return panel.select(year).distinct().subtract(population.select(year).distinct())


def extrapolate_years(population: DataFrame, years: DataFrame | Sequence[int], location: str) -> DataFrame:
    """Straight line through the first and last year of each location.

    ``years`` is a list, or a frame of years that is turned into one array by a
    scalar subquery (a calendar has few years), so nothing is cross joined.
    """
    if isinstance(years, DataFrame):
        wanted: Column = years.select(F.sort_array(F.collect_set(years.columns[0]))).scalar()
    else:
        wanted = F.array(*[F.lit(int(y)) for y in years])
    ends = population.groupBy(location).agg(
        F.min("year").alias("y0"), F.max("year").alias("y1"),
        F.min_by("population", "year").alias("p0"), F.max_by("population", "year").alias("p1"),
        F.min_by("population_density", "year").alias("d0"),
        F.max_by("population_density", "year").alias("d1"))

    def line(first: str, last: str) -> Column:
        slope = F.try_divide(F.col(last).cast("double") - F.col(first), F.col("y1") - F.col("y0"))
        return F.col(last) + slope * (F.col("year") - F.col("y1"))

    return ends.withColumn("year", F.explode(wanted)).select(
        location, F.col("year").cast("int").alias("year"),
        F.round(line("p0", "p1")).cast("bigint").alias("population"),
        line("d0", "d1").alias("population_density"))


def population_join(panel: DataFrame, population: DataFrame, location: str,
                    panel_years: DataFrame | None = None) -> DataFrame:
    """Attach population and density, extrapolated for years the table lacks.

    The table is folded to one row per location (a map from year to values, as long
    as the calendar), so the panel is joined on the location alone and keeps the
    partitioning its window features were computed on.
    """
    lacking = missing_years(panel if panel_years is None else panel_years, population)
    cols = [location, "year", "population", "population_density"]
    known = population.select(location, F.col("year").cast("int").alias("year"),
                              F.col("population").cast("bigint").alias("population"),
                              F.col("population_density").cast("double").alias("population_density"))
    both = known.unionByName(extrapolate_years(known, lacking, location).select(*cols))
    folded = both.groupBy(location).agg(F.map_from_entries(F.collect_list(F.struct(
        "year", F.struct("population", "population_density")))).alias("_years"))
    joined = panel.join(folded, location, "left")
    at = F.try_element_at("_years", F.col("year").cast("int"))
    return joined.withColumns({
        "population": at["population"], "population_density": at["population_density"],
    }).drop("_years")


def land_use_class(df: DataFrame, residential: Sequence[str], mark: str = "(2018)") -> DataFrame:
    """Residential share, whether it beats every other class, and by how much."""
    others = [c for c in df.columns if mark in c and c not in residential]
    share = F.lit(0.0)
    for c in residential:
        share = share + F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
    cols = [F.col(f"`{c}`").cast("double") for c in others]
    top = F.greatest(*cols) if len(cols) > 1 else cols[0]
    return df.withColumns({
        "residential_pct_2018": share,
        "max_non_residential_pct": top,
        "is_residential_dominant": F.coalesce(share > top, F.lit(False)),
        "residential_advantage": share - top,
    })


def classify_locations(df: DataFrame, lookup: DataFrame, residential: Sequence[str], key: str,
                       new: str, mark: str = "(2018)") -> DataFrame:
    """Land-use class of the rows whose code maps to a current one."""
    from .lookup import map_first_match

    mapped = map_first_match(land_use_class(df, residential, mark), lookup, key, key, new)
    return mapped.filter(F.col(new).isNotNull())
