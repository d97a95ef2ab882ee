"""The nested area hierarchy: build, enrich, flatten.

The nested document (borough -> wards -> areas) is an export format. The long
tables are the data: payloads are joined on the area before nesting, and every
tree row holds a bounded number of areas, so a borough or an area with much of the
data becomes several mergeable rows instead of one oversized row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import calendar as cal
from ..session import cut_lineage
from .skew import task_count

AREA_COLUMNS = ["lad", "lad_name", "ward", "ward_name", "loc", "loc_name"]
#: Values (entries of maps and arrays) that a row of the tree holds, on average over the parts of a borough.
MAX_CELLS = 1_000_000


def area_table(df: DataFrame, allowed: DataFrame | None = None, location: str = "loc") -> DataFrame:
    """One row per area (first by name columns), optionally limited to allowed areas."""
    from .cleaning import dedup_first

    areas = dedup_first(df.select(*AREA_COLUMNS), [location])
    if allowed is None:
        return areas
    return areas.join(allowed.select(location), location, "left_semi").select(*AREA_COLUMNS)


def entry_schema() -> T.StructType:
    """Everything an area entry of the exported document can hold."""
    text, whole = T.StringType(), T.LongType()
    point = T.StructType([T.StructField("longitude", T.DoubleType()),
                          T.StructField("latitude", T.DoubleType())])
    return T.StructType([
        T.StructField("name", text),
        T.StructField("predictions", T.MapType(text, T.DoubleType())),
        T.StructField("historical", T.MapType(text, whole)),
        T.StructField("officer_assignments", T.StructType([
            T.StructField("daily", T.MapType(text, T.IntegerType())),
            T.StructField("hourly", T.MapType(text, T.ArrayType(T.IntegerType())))])),
        T.StructField("burglaries_by_month", T.MapType(text, T.ArrayType(point))),
        T.StructField("total_burglary_count", whole),
        T.StructField("months_with_data", T.ArrayType(text)),
    ])


def tree_schema(entry: T.StructType | None = None) -> T.MapType:
    text = T.StringType()
    ward = T.StructType([T.StructField("name", text),
                         T.StructField("lsoas", T.MapType(text, entry or entry_schema()))])
    lad = T.StructType([T.StructField("name", text), T.StructField("wards", T.MapType(text, ward))])
    return T.MapType(text, lad)


def _cells(value: Column, kind: T.DataType) -> Column | None:
    """Number of values in the maps and arrays of ``value``; None if its type has none."""
    if isinstance(kind, T.StructType):
        parts = [_cells(value[f.name], f.dataType) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return sum(parts[1:], parts[0]) if parts else None
    if not isinstance(kind, T.MapType | T.ArrayType):
        return None
    inner = kind.valueType if isinstance(kind, T.MapType) else kind.elementType
    own = F.coalesce(F.when(value.isNotNull(), F.size(value)), F.lit(0)).cast("bigint")
    if not isinstance(inner, T.MapType | T.ArrayType):
        return own
    items = F.map_values(value) if isinstance(kind, T.MapType) else value
    return own + F.coalesce(F.aggregate(items, F.lit(0).cast("bigint"), lambda a, v: a + _cells(v, inner)), F.lit(0))


def content_tasks(df: DataFrame, cells: int, max_cells: int = MAX_CELLS) -> int:
    """Tasks for nested content of so many values, one per core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(cells / max_cells))


def nest_hierarchy(areas: DataFrame, payload: Sequence[str] = (), max_areas: int = 5000, *,
                   split: str | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """Long area rows -> (lad, part, tree).

    A borough with up to ``max_areas`` areas, whose payload comes to ``max_cells`` values at
    most, is one row. A larger one is cut into parts by a hash of the area code; each part
    is a valid document of its own, and the document of the borough is the union of its
    parts. ``split`` names a column that numbers several rows of one area: each number has
    parts of its own. Nested content is small while it travels: with a payload the tasks are
    as many as the values need, and not merged.
    """
    cells = [c for c in (_cells(F.col(f.name), f.dataType) for f in areas.schema if f.name in payload) if c is not None]
    amount = F.sum(sum(cells[1:], cells[0])) if cells else F.lit(0).cast("bigint")
    sizes = areas.groupBy("lad").agg(F.count("*").alias("_size"), amount.alias("_cells"))
    if cells:
        sizes = cut_lineage(sizes)
    parts = F.greatest(F.ceil(F.col("_size") / max_areas), F.ceil(F.col("_cells") / max_cells))
    cut = areas.join(sizes, "lad").withColumn(
        "part", (F.pmod(F.xxhash64("loc"), parts) + (parts * F.coalesce(F.col(split), F.lit(0)) if split else 0))
        .cast("int")).drop("_size", "_cells")
    if cells:
        cut = cut.repartition(content_tasks(areas, sizes.agg(F.sum("_cells")).first()[0] or 0, max_cells), "lad", "part")
    entry = F.struct(F.col("loc_name").alias("name"), *[F.col(c) for c in payload])
    wards = cut.groupBy("lad", "part", "ward").agg(
        F.min("lad_name").alias("_lad_name"), F.min("ward_name").alias("_name"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(
            F.col("loc").cast("string").alias("key"), entry.alias("value")))) if not payload
            else F.collect_list(F.struct(F.col("loc").cast("string").alias("key"),
                                         entry.alias("value")))).alias("_lsoas"))
    lads = wards.groupBy("lad", "part").agg(
        F.min("_lad_name").alias("_name"),
        F.map_from_entries(F.collect_list(F.struct(
            F.col("ward").cast("string").alias("key"),
            F.struct(F.col("_name").alias("name"), F.col("_lsoas").alias("lsoas")).alias("value"))))
        .alias("_wards"))
    return lads.select("lad", "part", F.create_map(
        F.col("lad").cast("string"),
        F.struct(F.col("_name").alias("name"), F.col("_wards").alias("wards"))).alias("tree"))


def flatten_tree(df: DataFrame, tree: str = "tree") -> DataFrame:
    """Tree rows -> one row per area with its entry struct (codes as text)."""
    lads = df.select(F.explode(tree).alias("lad", "_l")).select(
        "lad", F.col("_l.name").alias("lad_name"), F.col("_l.wards").alias("_wards"))
    # Names are taken out first: a row of the next level does not carry the whole one above it.
    wards = lads.select("lad", "lad_name", F.explode("_wards").alias("ward", "_w")).select(
        "lad", "lad_name", "ward", F.col("_w.name").alias("ward_name"), F.col("_w.lsoas").alias("_lsoas"))
    return wards.select("lad", "lad_name", "ward", "ward_name", F.explode("_lsoas").alias("loc", "entry")).withColumn(
        "loc_name", F.col("entry.name"))


def history_by_location(panel: DataFrame, location: str, count: str, out: str = "historical") -> DataFrame:
    """Location -> map from month key to count, in time order."""
    key = cal.month_key(F.col("year"), F.col("month"))
    return panel.groupBy(location).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(key.alias("key"), F.col(count).alias("value"))))).alias(out))


def month_map(df: DataFrame, location: str, month: str, value: str, out: str) -> DataFrame:
    """Location -> map from month key to a value."""
    return df.groupBy(location).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col(month).alias("key"), F.col(value).alias("value"))))).alias(out))


def nest_points(events: DataFrame, location: str, month: str, lon: str, lat: str, *,
                max_points: int = 10_000) -> DataFrame:
    """(location, part, burglaries_by_month, total_burglary_count, months_with_data).

    Equal points are counted before anything is gathered. A location with more than
    ``max_points`` points is spread over parts (a point repeated very often over
    several of them), each part carrying whole totals, so no row or group grows with
    the hottest location; together the parts hold every point. Nested points are small
    while they travel: the tasks are as many as the events need, and not merged.
    """
    tasks = task_count(events.sparkSession, events.count())
    points = cut_lineage(events.groupBy(location, month, lon, lat).agg(F.count("*").alias("_n")))
    totals = points.groupBy(location).agg(
        F.sum("_n").alias("total_burglary_count"),
        F.sort_array(F.collect_set(month)).alias("months_with_data"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / max_points)))
    spread = (points.withColumn("_chunk", chunk)
              .join(totals.select(location, F.ceil(F.col("total_burglary_count") / max_points)
                                  .alias("_parts")), location)
              .withColumn("part", F.pmod(F.xxhash64(month, lon, lat, "_chunk"), F.col("_parts"))
                          .cast("int"))
              .withColumn("_copies", F.least(F.lit(max_points),
                                             F.col("_n") - F.col("_chunk") * max_points).cast("int")))
    point = F.struct(F.col(lon).alias("longitude"), F.col(lat).alias("latitude"))
    monthly = spread.repartition(tasks, location, "part").groupBy(location, "part", month).agg(
        F.flatten(F.collect_list(F.array_repeat(point, F.col("_copies")))).alias("_points"))
    nested = monthly.groupBy(location, "part").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col(month).alias("key"), F.col("_points").alias("value")))))
        .alias("burglaries_by_month"))
    return nested.repartition(tasks, location).join(totals, location)


def attach(areas: DataFrame, payload: DataFrame, location: str = "loc") -> DataFrame:
    """Left join of a per-location payload: areas without one keep NULL.

    Nested content is larger than the statistics say, so it is not broadcast.
    """
    return areas.join(payload.hint("merge"), location, "left")


def integrate_all(areas: DataFrame, predictions: DataFrame, history: DataFrame,
                  roster: DataFrame, location: str = "loc") -> DataFrame:
    """Areas with predictions, history (empty map when absent) and officer assignments.

    ``predictions`` and ``history`` are per-location maps, ``roster`` is the long
    table (location, month_key, officers_assigned, hourly).
    """
    officers = roster.groupBy(location).agg(F.struct(
        F.map_from_entries(F.collect_list(F.struct("month_key", "officers_assigned"))).alias("daily"),
        F.map_from_entries(F.collect_list(F.struct("month_key", "hourly"))).alias("hourly"),
    ).alias("officer_assignments"))
    joined = attach(attach(attach(areas, predictions, location), history, location), officers, location)
    empty = F.create_map().cast("map<string,bigint>")
    return joined.withColumn("historical", F.coalesce(F.col("historical"), empty))


def tree_summary(points: DataFrame, lad: str, location: str, month: str) -> DataFrame:
    """Boroughs, locations with data, events, month range and number of months.

    Events are counted per location and month first (combined map-side): the distinct
    counts see these few rows, not three copies of every event.
    """
    cells = points.groupBy(lad, location, month).agg(F.count("*").alias("_n"))
    return cells.agg(
        F.countDistinct(lad).alias("n_lads"), F.countDistinct(location).alias("n_locations"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_events"), F.min(month).alias("first_month"),
        F.max(month).alias("last_month"), F.countDistinct(month).alias("n_months"))
