"""From event rows to a dense location-by-month panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar as cal
from .skew import task_count

MONTH_COLUMNS = ["year", "month", "month_sin", "month_cos", "time_index_norm"]


def normalize_time(df: DataFrame, date_col: str = "Month") -> DataFrame:
    """Add year, month, the cyclic month encoding and the scaled time index.

    The index is scaled by whole years times 12 (at least 1), so its maximum is 1
    only when the data end in the month they started in. The bounds are a scalar
    subquery: one aggregate row, no global window and no join. Column names ignore
    case in Spark, so a text column called ``Month`` is kept as ``Month_text``.
    """
    day = cal.month_start(F.col(date_col))
    year, month = F.year(day), F.month(day)
    bounds = df.select(F.struct(
        F.min(day).alias("first"), F.max(day).alias("last")).alias("b")).scalar()
    first_year = F.year(bounds["first"])
    span = (F.year(bounds["last"]) - first_year) * 12
    offset = cal.month_index(year, month) - cal.month_index(
        first_year, F.month(bounds["first"]))
    if date_col.lower() in MONTH_COLUMNS:
        df = df.withColumn(f"{date_col}_text", F.col(date_col))
    return df.withColumns({
        "year": year,
        "month": month,
        "month_sin": cal.month_sin(month),
        "month_cos": cal.month_cos(month),
        "time_index_norm": offset / F.when(span == 0, 1).otherwise(span),
    })


def count_by(df: DataFrame, *keys: str, count: str = "count", weight: str | None = None) -> DataFrame:
    """Rows per key (or the sum of a pre-aggregated weight), combined map-side."""
    value = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(value.cast("bigint").alias(count))


def densify_grid(df: DataFrame, location: str = "loc", count: str = "count", *,
                 weight: str | None = None, calendar: bool = False,
                 month_columns: list[str] | None = None) -> DataFrame:
    """Every location with every month, count 0 where nothing happened.

    Rows are counted first; each location then holds one map of its observed
    months, and the month axis (a scalar subquery whose size is bounded by the
    calendar) is exploded against it. The grid therefore needs no join at all, and
    it leaves partitioned by location, which is what the window features require.
    A counted map becomes as many rows as there are months, which no statistics of the
    shuffle before it show: a grid of more rows than ``TASK_ROWS`` a core is dealt out in
    partitions of about that many, and these are not merged.

    By default only months seen somewhere in the data appear; ``calendar=True``
    also fills months that are absent everywhere (it needs the columns of
    ``normalize_time``).
    """
    cols = month_columns or [c for c in MONTH_COLUMNS if c in df.columns]
    counts = count_by(df, location, "year", "month", count=count, weight=weight)
    key = cal.month_index(F.col("year"), F.col("month"))
    months = F.max(key) - F.min(key) + 1 if calendar else F.approx_count_distinct(key)
    rows = df.agg(F.approx_count_distinct(location) * months).first()[0] or 0
    parts = task_count(df.sparkSession, rows)
    if parts > df.sparkSession.sparkContext.defaultParallelism:
        counts = counts.repartition(parts, location)
    observed = counts.groupBy(location).agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.col(count)))).alias("_observed"))
    if calendar:
        bounds = df.select(F.struct(
            F.min(key).alias("lo"), F.max(key).alias("hi"),
            F.min("year").alias("y0"), F.max("year").alias("y1")).alias("b")).scalar()
        observed = observed.withColumn("_b", bounds)
        axis = _calendar_axis(F.col("_b"))
    else:
        axis = df.select(*cols).distinct().select(
            F.sort_array(F.collect_list(F.struct(*cols))).alias("m")).scalar()
    grid = observed.select(location, "_observed", F.explode(axis).alias("_m"))
    at = cal.month_index(F.col("_m.year"), F.col("_m.month"))
    return grid.select(
        location, *[F.col(f"_m.{c}").alias(c) for c in (MONTH_COLUMNS if calendar else cols)],
        F.coalesce(F.try_element_at("_observed", at), F.lit(0)).cast("bigint").alias(count))


def _calendar_axis(bounds: Column) -> Column:
    """All months between the first and the last one, with their encodings."""
    span = (bounds["y1"] - bounds["y0"]) * 12

    def month_row(k: Column) -> Column:
        year, month = F.floor(k / 12).cast("int"), (k % 12 + 1).cast("int")
        return F.struct(
            year.alias("year"), month.alias("month"),
            cal.month_sin(month).alias("month_sin"), cal.month_cos(month).alias("month_cos"),
            ((k - bounds["lo"]) / F.when(span == 0, 1).otherwise(span)).alias("time_index_norm"))

    return F.transform(F.sequence(bounds["lo"], bounds["hi"]), month_row)


def distinct_locations(df: DataFrame, location: str) -> DataFrame:
    return df.select(location).distinct()


def distinct_months(df: DataFrame) -> DataFrame:
    return df.select("year", "month").distinct()
