"""Spatial queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import spatial

from . import standins as s
from .core import query, r6, table

EDGE_QUERY = f"""WITH {s.EDGES_SQL} SELECT location, neighbor, round(distance, 6) AS distance, neighbor_rank FROM edges"""


def _edges(d):
    return d.select("location", "neighbor", r6("distance", "distance"), "neighbor_rank")


@query("knn_edges", EDGE_QUERY)
def knn_edges(spark, sf):
    return _edges(spatial.knn_edges(s.centroids(spark, sf), "vec_id", "x", "y"))


@query("knn_edges_divided", EDGE_QUERY)
def knn_edges_divided(spark, sf):
    """The space-dividing search for tables of any size, forced on."""
    return _edges(spatial.knn_edges(s.centroids(spark, sf), "vec_id", "x", "y", small=0))


NEIGHBOR_SQL = f"""WITH {s.panel_sql()}, {s.EDGES_SQL},
j AS (SELECT p.loc, p.year, p.month, q.x AS c, e.distance, e.neighbor_rank FROM panel p
  LEFT JOIN edges e ON e.location = p.loc
  LEFT JOIN panel q ON q.loc = e.neighbor AND q.year = p.year AND q.month = p.month)
SELECT loc, year, month, round(avg(c), 6) AS neighbor_avg, max(c) AS neighbor_max,
  round(stddev_samp(c), 6) AS neighbor_std,
  round(coalesce(sum(c / (distance + 100)), 0) / sum(1 / (distance + 100)), 6) AS neighbor_weighted_avg,
  max(CASE WHEN neighbor_rank = 1 THEN c END) AS closest_neighbor FROM j GROUP BY ALL"""


@query("neighbor_features", NEIGHBOR_SQL)
def neighbor_features(spark, sf):
    edges = s.edges(spark, sf)
    d = spatial.add_neighbor_features(s.panel(spark, sf), edges, "loc", "x")
    return d.select("loc", "year", "month", r6("neighbor_avg", "neighbor_avg"), "neighbor_max",
                    r6("neighbor_std", "neighbor_std"), r6("neighbor_weighted_avg", "neighbor_weighted_avg"),
                    "closest_neighbor")


STATION_QUERY = f"""WITH {s.GEO_SQL} SELECT vec_id, nearest_station, round(d, 3) AS distance_m FROM best"""


def _stations(spark, sf, **options):
    g = s.geo_points(spark, sf)
    posts = g.filter("label = 0").select(F.col("vec_id").alias("station"), F.col("lat").alias("slat"),
                                         F.col("lon").alias("slon"))
    return spatial.nearest_station(g, "lat", "lon", posts, "station", "slat", "slon", **options)


@query("nearest_station", STATION_QUERY)
def nearest_station(spark, sf):
    return _stations(spark, sf).select("vec_id", "nearest_station", r6("distance_m", "distance_m", 3))


@query("nearest_station_divided", STATION_QUERY)
def nearest_station_divided(spark, sf):
    """The search for station tables of any size, forced on."""
    return _stations(spark, sf, small=0).select("vec_id", "nearest_station", r6("distance_m", "distance_m", 3))


@query("distance_histogram", """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 200)), 199) AS INTEGER) AS bin, count(*) AS n
FROM lineitem CROSS JOIN b GROUP BY ALL""")
def distance_histogram(spark, sf):
    return spatial.distance_histogram(table(spark, sf, "lineitem"), "l_extendedprice")


@query("distance_histogram_stations", f"""WITH {s.GEO_SQL}, b AS (SELECT min(d) AS lo, max(d) AS hi FROM best)
SELECT CAST(least(floor((d - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
FROM best CROSS JOIN b GROUP BY ALL""")
def distance_histogram_stations(spark, sf):
    return spatial.distance_histogram(_stations(spark, sf), "distance_m", 20)


@query("colocated_points", """WITH e AS (SELECT event_id, round(51.0::DOUBLE + floor(value) / 100, 6) AS place_lat,
  round(user_id / 1000.0::DOUBLE, 6) AS place_lon FROM events)
SELECT event_id, place_lat, place_lon, row_number() OVER (PARTITION BY place_lat, place_lon ORDER BY event_id) AS ordinal,
  count(*) OVER (PARTITION BY place_lat, place_lon) AS place_size FROM e""")
def colocated_points(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", (F.lit(51.0) + F.floor("value") / 100).alias("lat"), (F.col("user_id") / 1000).alias("lon"))
    return spatial.colocated_points(e, "lat", "lon", "event_id").drop("lat", "lon")
