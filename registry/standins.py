"""Stand-ins for the domain tables, derived from the given tables.

Each stand-in exists twice: as a Spark frame and as the SQL text of a common table
expression, so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arealis.operators import panel as p
from arealis.plans.feature_table import month_counts

from .core import table

# ---------------------------------------------------------------- events


def events(spark: SparkSession, sf: str, key: str = "l_suppkey") -> DataFrame:
    """Event rows: location, month text, type, flags and point."""
    return table(spark, sf, "lineitem").select(
        F.col(key).alias("loc"), F.date_format("l_shipdate", "yyyy-MM").alias("ym"),
        F.col("l_returnflag").alias("kind"), F.col("l_discount").alias("lon"),
        (F.lit(51.0) + F.col("l_tax")).alias("lat"))


def ev_sql(key: str = "l_suppkey") -> str:
    return f"""ev AS (SELECT {key} AS loc, strftime(l_shipdate, '%Y-%m') AS ym,
  CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
  l_returnflag AS kind, l_discount AS lon, 51.0::DOUBLE + l_tax AS lat FROM lineitem)"""


def dated(spark: SparkSession, sf: str, key: str = "l_suppkey") -> DataFrame:
    return p.normalize_time(events(spark, sf, key), "ym")


def panel(spark: SparkSession, sf: str, key: str = "l_suppkey") -> DataFrame:
    """Dense panel: loc, year, month, calendar columns, x; the events are counted in one pass."""
    counts = p.normalize_time(month_counts(events(spark, sf, key), "loc", "ym"), "ym")
    return p.densify_grid(counts, "loc", "x", weight="_events")


def panel_sql(key: str = "l_suppkey") -> str:
    return ev_sql(key) + """,
mon AS (SELECT DISTINCT year, month, ym FROM ev),
locs AS (SELECT DISTINCT loc FROM ev),
cnt AS (SELECT loc, ym, count(*) AS n FROM ev GROUP BY loc, ym),
panel AS (SELECT l.loc, m.year, m.month, m.ym, CAST(coalesce(c.n, 0) AS BIGINT) AS x,
  row_number() OVER (PARTITION BY l.loc ORDER BY m.year, m.month) - 1 AS t
  FROM locs l CROSS JOIN mon m LEFT JOIN cnt c ON c.loc = l.loc AND c.ym = m.ym)"""


TIME_SQL = """bounds AS (SELECT min(year) AS y0, max(year) AS y1, min(year * 12 + month - 1) AS i0 FROM ev),
norm AS (SELECT m.year, m.month, sin((m.month - 1) * (pi() / 6)) AS month_sin,
  cos((m.month - 1) * (pi() / 6)) AS month_cos,
  (m.year * 12 + m.month - 1 - b.i0)::DOUBLE
    / CASE WHEN b.y1 = b.y0 THEN 1 ELSE (b.y1 - b.y0) * 12 END AS tin
  FROM (SELECT DISTINCT year, month FROM ev) m CROSS JOIN bounds b)"""

# ---------------------------------------------------------------- areas


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """region -> nation -> supplier as borough -> ward -> area."""
    return (table(spark, sf, "supplier")
            .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("r_regionkey").alias("lad"), F.col("r_name").alias("lad_name"),
                    F.col("n_nationkey").alias("ward"), F.col("n_name").alias("ward_name"),
                    F.col("s_suppkey").alias("loc"), F.col("s_name").alias("loc_name")))


AREAS_SQL = """areas AS (SELECT r_regionkey AS lad, r_name AS lad_name, n_nationkey AS ward,
  n_name AS ward_name, s_suppkey AS loc, s_name AS loc_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Old code, change flag, new code; flag S has two targets (a split)."""
    s = table(spark, sf, "supplier")
    nation = Window.partitionBy("s_nationkey")
    bal = F.col("s_acctbal")
    flag = F.when(bal < 2000, "S").when(bal < 4000, "M").when(bal < 6000, "X").otherwise("U")
    base = s.select(
        F.col("s_suppkey").alias("old_code"), flag.alias("chgind"),
        F.when(bal < 6000, F.min("s_suppkey").over(nation)).otherwise(F.col("s_suppkey")).alias("new_code"))
    split = s.filter(bal < 2000).select(
        F.col("s_suppkey").alias("old_code"), F.lit("S").alias("chgind"),
        F.max("s_suppkey").over(nation).alias("new_code"))
    return base.unionByName(split)


CHANGES_SQL = """chg AS (SELECT s_suppkey AS old_code,
  CASE WHEN s_acctbal < 2000 THEN 'S' WHEN s_acctbal < 4000 THEN 'M' WHEN s_acctbal < 6000 THEN 'X'
    ELSE 'U' END AS chgind,
  CASE WHEN s_acctbal < 6000 THEN min(s_suppkey) OVER (PARTITION BY s_nationkey)
    ELSE s_suppkey END AS new_code FROM supplier
  UNION ALL SELECT s_suppkey, 'S', max(s_suppkey) OVER (PARTITION BY s_nationkey)
  FROM supplier WHERE s_acctbal < 2000)"""

RESIDENTIAL = ("Continuous urban fabric [111] (2018)", "Discontinuous urban fabric [112] (2018)")


def land_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Land-cover percentages per supplier."""
    def mean(flag: str):
        return F.avg(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("loc")).agg(
        (F.avg("l_discount") * 255).alias(RESIDENTIAL[0]),
        (F.avg("l_tax") * 320).alias(RESIDENTIAL[1]),
        mean("R").alias("Industrial units [121] (2018)"),
        mean("N").alias("Green urban areas [141] (2018)"),
        mean("A").alias("Green urban areas [141] (2012)"))


LAND_SQL = """land AS (SELECT l_suppkey AS loc, avg(l_discount) * 255 + avg(l_tax) * 320 AS share,
  greatest(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END),
           avg(CASE WHEN l_returnflag = 'N' THEN l_quantity END)) AS top
  FROM lineitem GROUP BY l_suppkey),
classes AS (SELECT loc, share, top, coalesce(share > top, FALSE) AS dominant, share - top AS advantage
  FROM land)"""


def classes(spark: SparkSession, sf: str) -> DataFrame:
    from arealis.operators.demographics import land_use_class

    return land_use_class(land_cover(spark, sf), RESIDENTIAL)

# ---------------------------------------------------------------- demographics


POP_YEARS = (1995, 1996, 1997, 1998, 1999)


def population_wide(spark: SparkSession, sf: str) -> DataFrame:
    """One column per measure and year, named like the published table."""
    year = F.year("l_shipdate")
    cols = [c for y in POP_YEARS for c in (
        F.count(F.when(year == y, 1)).alias(f"Mid-{y}: Population"),
        F.avg(F.when(year == y, F.col("l_extendedprice"))).alias(f"Mid-{y}: People per Sq Km"))]
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("loc")).agg(*cols)


POP_SQL = """pop AS (SELECT l_suppkey AS loc, CAST(y.y AS INTEGER) AS year,
  count(CASE WHEN year(l_shipdate) = y.y THEN 1 END) AS population,
  avg(CASE WHEN year(l_shipdate) = y.y THEN l_extendedprice END) AS density
  FROM lineitem CROSS JOIN (SELECT unnest([1995, 1996, 1997, 1998, 1999]) AS y) y
  GROUP BY l_suppkey, y.y)"""

EXTRA_SQL = """ends AS (SELECT loc, min(year) AS y0, max(year) AS y1,
  arg_min(population, year) AS p0, arg_max(population, year) AS p1,
  arg_min(density, year) AS d0, arg_max(density, year) AS d1 FROM pop GROUP BY loc),
lack AS (SELECT DISTINCT year FROM ev WHERE year NOT IN (SELECT year FROM pop)),
extra AS (SELECT e.loc, l.year,
  CAST(round(p1 + (p1::DOUBLE - p0) / (y1 - y0) * (l.year - y1)) AS BIGINT) AS population,
  d1 + (d1 - d0) / (y1 - y0) * (l.year - y1) AS density FROM ends e CROSS JOIN lack l)"""


def population(spark: SparkSession, sf: str) -> DataFrame:
    from arealis.operators.demographics import population_long

    return population_long(population_wide(spark, sf), "loc")


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of a score per supplier with their years."""
    from arealis.operators.lookup import version_union

    s = table(spark, sf, "supplier")

    def version(factor: float) -> DataFrame:
        return s.select(F.col("s_suppkey").alias("loc"), (F.col("s_acctbal") * factor).alias("imd_score"))

    return version_union([(version(1.0), 1996, 1996), (version(1.1), 1997, 1999), (version(1.2), 2000, None)])


SNAP_SQL = """snap AS (SELECT s_suppkey AS loc, s_acctbal * v.f AS imd_score, v.a, v.b FROM supplier
  CROSS JOIN (VALUES (1.0::DOUBLE, 1996, 1996), (1.1::DOUBLE, 1997, 1999), (1.2::DOUBLE, 2000, 9999)) v(f, a, b))"""


def housing_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Dwelling counts as published: text with thousands marks, quotes and dashes."""
    text = F.concat(F.lit('"'), F.format_number(F.round(F.col("p_retailprice") * 1000), 0), F.lit('"'))
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") > 25, "LSOA").otherwise("MSOA").alias("GEOGRAPHY"),
        F.col("p_partkey").alias("ECODE"), F.col("p_name").alias("AREA_NAME"),
        F.when(F.col("p_type") == "ECONOMY", "All").otherwise("A").alias("BAND"),
        F.when(F.col("p_brand") == "Brand#2", "-").when(F.col("p_brand") == "Brand#3", "n/a")
        .otherwise(text).alias("DWELLINGS"),
        F.format_number(F.col("p_size") * 1000, 0).alias("ROOMS"))


HOUSING_SQL = """house AS (SELECT CASE WHEN p_size > 25 THEN 'LSOA' ELSE 'MSOA' END AS geography,
  p_partkey AS ecode, p_name AS area_name, CASE WHEN p_type = 'ECONOMY' THEN 'All' ELSE 'A' END AS band,
  CASE WHEN p_brand = 'Brand#2' THEN 0 WHEN p_brand = 'Brand#3' THEN NULL
    ELSE CAST(round(p_retailprice * 1000) AS BIGINT) END AS dwellings,
  CAST(p_size * 1000 AS BIGINT) AS rooms FROM part)"""


def housing(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers for some of the locations."""
    return table(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000).select(
        F.col("s_suppkey").alias("loc"), F.col("s_name").alias("AREA_NAME"),
        F.round(F.col("s_acctbal")).cast("bigint").alias("dwellings"))

# ---------------------------------------------------------------- points


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id"), F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"), "label")


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbour edges, written once: the features read them several times."""
    from arealis.operators.spatial import knn_edges
    from arealis.session import cut_lineage

    return cut_lineage(knn_edges(centroids(spark, sf), "vec_id", "x", "y"))


def geo_points(spark: SparkSession, sf: str) -> DataFrame:
    return centroids(spark, sf).select(
        "vec_id", (F.lit(51.5) + F.col("x")).alias("lat"), F.col("y").alias("lon"), "label")


POINTS_SQL = """pts AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label FROM embeddings)"""

EDGES_SQL = POINTS_SQL + """,
pairs AS (SELECT a.vec_id AS location, b.vec_id AS neighbor,
  sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance
  FROM pts a JOIN pts b ON a.vec_id <> b.vec_id),
edges AS (SELECT * FROM (SELECT location, neighbor, distance,
  row_number() OVER (PARTITION BY location ORDER BY distance, neighbor) AS neighbor_rank FROM pairs)
  WHERE neighbor_rank <= 5)"""

GEO_SQL = """geo AS (SELECT vec_id, 51.5::DOUBLE + embedding[1]::DOUBLE AS lat, embedding[2]::DOUBLE AS lon, label
  FROM embeddings),
near AS (SELECT g.vec_id, s.vec_id AS nearest_station, 2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
    power(sin((radians(s.lat) - radians(g.lat)) / 2), 2)
    + cos(radians(g.lat)) * cos(radians(s.lat)) * power(sin((radians(s.lon) - radians(g.lon)) / 2), 2)))) AS d
  FROM geo g JOIN geo s ON s.label = 0),
best AS (SELECT vec_id, min(d) AS d, arg_min(nearest_station, d) AS nearest_station FROM near GROUP BY vec_id)"""
