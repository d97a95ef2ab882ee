"""Sources, sinks, cleaning, joins, demographics and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from arealis.operators import cleaning, demographics as demo, eda, lookup, panel as p, spatial, tree
from arealis.functions.scalars import drop_last_word
from arealis.session import shared_folder
from arealis.sources import readers, sinks

from . import standins as s
from .core import query, r6, table

EV = s.ev_sql()
PANEL = s.panel_sql()


def folder(spark) -> str:
    """Fresh folder next to the session's checkpoints."""
    return f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"


# -- sources and sinks ----------------------------------------------------

@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_parquet(spark, sf):
    by_path = readers.to_dataframe(spark, f"{sf.rstrip('/')}/orders.parquet")
    return readers.to_dataframe(spark, by_path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("scan_lookup", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def scan_lookup(spark, sf):
    path = folder(spark)
    sinks.write_csv(table(spark, sf, "supplier"), path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")])
    return readers.scan_lookup(spark, path, ["s_suppkey", "s_name"], schema)


@query("collect_events", f"""WITH {s.CHANGES_SQL},
m AS (SELECT old_code, max(new_code::VARCHAR) AS new_code FROM chg WHERE chgind IN ('S', 'M', 'X') GROUP BY old_code),
r AS (SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey::VARCHAR END AS id,
  strftime(l_shipdate, '%Y-%m') AS ym, l_extendedprice AS lon,
  coalesce(m.new_code, l_suppkey::VARCHAR) AS code FROM lineitem LEFT JOIN m ON m.old_code = l_suppkey
  WHERE l_returnflag = 'R')
SELECT id AS crime_id, ym, lon, code FROM r
WHERE id IS NOT NULL AND code IN (SELECT new_code::VARCHAR FROM chg)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ym, lon, code) = 1""")
def collect_events(spark, sf):
    """Extract files in nested folders -> recoded, valid events, one per id."""
    path = folder(spark)
    li = table(spark, sf, "lineitem")
    raw = li.select(
        F.when(F.col("l_linenumber") == 1, "").otherwise(F.col("l_orderkey").cast("string")).alias("Crime ID"),
        F.date_format("l_shipdate", "yyyy-MM").alias("ym"), F.col("l_extendedprice").alias("Longitude"),
        F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("LSOA code"),
        F.col("l_returnflag").alias("Crime type"), F.col("l_linestatus").alias("part"))
    raw.write.partitionBy("part").option("header", True).csv(path)
    schema = T.StructType([T.StructField(c, T.DoubleType() if c == "Longitude" else T.StringType())
                           for c in raw.columns[:-1]])
    files = readers.read_events(spark, path, "*.csv", schema)
    codes = s.changes(spark, sf).select(
        F.col("old_code").cast("string").alias("LSOA11CD"), F.col("new_code").cast("string").alias("LSOA21CD"),
        F.col("chgind").alias("CHGIND"))
    out = lookup.collect_events(files, codes, kind="R")
    return out.select(F.col("Crime ID").alias("crime_id"), "ym", F.col("Longitude").alias("lon"),
                      F.col("LSOA code").alias("code"))


TREE_SQL = f"""WITH {s.AREAS_SQL} SELECT lad::VARCHAR AS lad, lad_name, ward::VARCHAR AS ward, ward_name,
  loc::VARCHAR AS loc, loc_name FROM areas"""


@query("read_json_tree", TREE_SQL)
def read_json_tree(spark, sf):
    path = folder(spark)
    sinks.write_json_tree(tree.nest_hierarchy(tree.area_table(s.areas(spark, sf))), path)
    got = readers.read_json_tree(spark, [path + "-missing", path])
    return tree.flatten_tree(got).drop("entry")


@query("sink_parquet", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_parquet(spark, sf):
    path = folder(spark)
    sinks.write_parquet(table(spark, sf, "supplier"), path)
    return readers.to_dataframe(spark, path)


@query("sink_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_csv(spark, sf):
    path = folder(spark)
    df = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.write_csv(df, path)
    return spark.read.option("header", True).schema(df.schema).csv(path)


@query("sink_json_tree", f"""WITH {s.AREAS_SQL}, {PANEL} SELECT a.loc::VARCHAR AS loc, p.ym AS month_key, p.x AS n
FROM areas a JOIN panel p ON p.loc = a.loc""")
def sink_json_tree(spark, sf):
    """Tree with history maps, written and read back as rows."""
    path = folder(spark)
    history = tree.history_by_location(s.panel(spark, sf), "loc", "x")
    full = tree.attach(tree.area_table(s.areas(spark, sf)), history)
    sinks.write_json_tree(tree.nest_hierarchy(full, ["historical"]), path)
    flat = tree.flatten_tree(readers.read_json_tree(spark, path))
    return flat.select("loc", F.explode("entry.historical").alias("month_key", "n"))


# -- cleaning -------------------------------------------------------------

@query("clean_numeric", f"WITH {s.HOUSING_SQL} SELECT * FROM house")
def clean_numeric(spark, sf):
    d = cleaning.clean_numeric(s.housing_raw(spark, sf), ["GEOGRAPHY", "ECODE", "AREA_NAME", "BAND"])
    return d.toDF(*[c.lower() for c in d.columns])


@query("housing_extract", f"""WITH {s.HOUSING_SQL} SELECT ecode AS loc, area_name,
  coalesce(dwellings, 0) AS dwellings, rooms FROM house
  WHERE band = 'All' AND geography = 'LSOA' AND ecode IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')""")
def housing_extract(spark, sf):
    clean = cleaning.clean_numeric(s.housing_raw(spark, sf), ["GEOGRAPHY", "ECODE", "AREA_NAME", "BAND"])
    codes = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("code"))
    d = cleaning.housing_extract(clean, codes, "code")
    return d.toDF(*[c.lower() for c in d.columns])


@query("harmonise_columns", """SELECT s_acctbal AS "IMD Score", s_suppkey AS "LSOA code", s_nationkey AS "Rank"
FROM supplier""")
def harmonise_columns(spark, sf):
    raw = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "LSOA", "s_acctbal": "IMD SCORE"})
    at = [raw.columns.index(c) for c in ("LSOA", "s_nationkey", "IMD SCORE")]
    return cleaning.harmonise_columns(
        raw, at, {"LSOA": "LSOA code", "IMD SCORE": "IMD Score", "s_nationkey": "Rank"},
        ["IMD Score", "LSOA code", "Rank"])


@query("sanitize_names", """SELECT s_suppkey AS LSOA_code, s_acctbal AS Income_Score__rate_,
  s_nationkey AS Education__Skills FROM supplier""")
def sanitize_names(spark, sf):
    raw = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("LSOA code"), F.col("s_acctbal").alias("Income Score (rate)"),
        F.col("s_nationkey").alias("Education, Skills"))
    safe = cleaning.sanitize_names(raw)
    numbered, original = cleaning.positional_names(raw)
    assert numbered.columns == ["f0", "f1", "f2"] and original == raw.columns
    return safe


@query("filter_prefix", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' OR p_name LIKE '%ring%'")
def filter_prefix(spark, sf):
    return cleaning.filter_prefix(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"),
                                  "p_brand", "Brand#1", "p_name", "ring")


@query("filter_nonnull_points", f"""WITH {EV}, {s.LAND_SQL}
SELECT ev.loc, ym, nullif(lon, 0) AS lon, nullif(lat, 51.0) AS lat, count(*) AS n FROM ev
JOIN classes c ON c.loc = ev.loc AND c.dominant WHERE lon <> 0 AND lat <> 51.0 GROUP BY ALL""")
def filter_nonnull_points(spark, sf):
    ev = s.events(spark, sf).withColumns({"lon": F.expr("nullif(lon, 0.0D)"), "lat": F.expr("nullif(lat, 51.0D)")})
    allowed = s.classes(spark, sf).filter("is_residential_dominant")
    d = cleaning.filter_nonnull_points(ev, allowed, "loc", "lon", "lat", "ym")
    return d.groupBy("loc", "ym", "lon", "lat").agg(F.count("*").alias("n"))


@query("extract_borough", r"""SELECT regexp_replace(p_name || '  ' || p_brand, '\s+\S+$', '') AS borough,
  count(*) AS n FROM part GROUP BY ALL""")
def extract_borough(spark, sf):
    name = F.concat_ws("  ", "p_name", "p_brand")
    return table(spark, sf, "part").groupBy(drop_last_word(name).alias("borough")).agg(F.count("*").alias("n"))


@query("drop_bad_rows", """WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS a,
  CASE WHEN l_discount = 0 THEN NULL WHEN l_discount > 0.09 THEN 'Infinity'::DOUBLE ELSE l_discount END AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, a, b, a * b AS product FROM t WHERE b IS NOT NULL AND NOT isinf(b)""")
def drop_bad_rows(spark, sf):
    d = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("a"),
        F.when(F.col("l_discount") == 0, None).when(F.col("l_discount") > 0.09, float("inf"))
        .otherwise(F.col("l_discount")).alias("b"))
    return cleaning.drop_bad_rows(d, ["a", "b"], ("product", "a", "b"))


@query("dedup_events", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""")
def dedup_events(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_extendedprice")
    return cleaning.dedup_first(d, ["l_orderkey", "l_linenumber"])


@query("dedup_first", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def dedup_first(spark, sf):
    d = cleaning.dedup_first(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"])
    return d.select("o_custkey", "o_orderkey", "o_totalprice")


# -- joins ----------------------------------------------------------------

@query("build_lookup", """SELECT c_custkey, c_nationkey, n_name, r_name FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
WHERE r_name LIKE 'A%'""")
def build_lookup(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_name", "n_regionkey")
    region = nation.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "key", "r_name")
    base = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_nationkey").alias("key"))
    return lookup.build_lookup([base, nation, region], "key", ["c_custkey", "c_nationkey", "n_name", "r_name"],
                               F.col("r_name").startswith("A"))


@query("recode_location", f"""WITH {s.CHANGES_SQL}, {EV},
m AS (SELECT old_code, max(new_code) AS new_code FROM chg WHERE chgind IN ('S', 'M', 'X') GROUP BY old_code)
SELECT coalesce(m.new_code, ev.loc) AS loc, ym, count(*) AS n FROM ev LEFT JOIN m ON m.old_code = ev.loc GROUP BY ALL""")
def recode_location(spark, sf):
    d = lookup.recode_location(s.events(spark, sf), "loc", s.changes(spark, sf), "old_code", "new_code", "chgind")
    return p.count_by(d, "loc", "ym", count="n")


@query("semi_residential", f"""WITH {PANEL}, {s.LAND_SQL}
SELECT p.loc, p.year, p.month, p.x FROM panel p JOIN classes c ON c.loc = p.loc WHERE c.dominant""")
def semi_residential(spark, sf):
    d = lookup.semi_filter(s.panel(spark, sf), "loc", s.classes(spark, sf), "loc")
    return d.select("loc", "year", "month", "x")


@query("snapshot_join", f"""WITH {PANEL}, {s.SNAP_SQL}
SELECT p.loc, p.year, p.month, p.x, round(s.imd_score, 6) AS imd_score FROM panel p
LEFT JOIN snap s ON s.loc = p.loc AND p.year BETWEEN s.a AND s.b WHERE p.year >= 1996""")
def snapshot_join(spark, sf):
    d = lookup.snapshot_join(s.panel(spark, sf), s.snapshots(spark, sf), "loc")
    return d.select("loc", "year", "month", "x", r6("imd_score", "imd_score"))


@query("population_join", f"""WITH {PANEL}, {s.POP_SQL}, {s.EXTRA_SQL},
a AS (SELECT loc, year, population, density FROM pop UNION ALL SELECT loc, year, population, density FROM extra)
SELECT p.loc, p.year, p.month, p.x, a.population, round(a.density, 4) AS population_density
FROM panel p LEFT JOIN a ON a.loc = p.loc AND a.year = p.year""")
def population_join(spark, sf):
    d = demo.population_join(s.panel(spark, sf), s.population(spark, sf), "loc", s.dated(spark, sf))
    return d.select("loc", "year", "month", "x", "population", r6("population_density", "population_density", 4))


@query("housing_join", f"""WITH {PANEL} SELECT p.loc, p.year, p.month, p.x,
  coalesce(CAST(round(s_acctbal) AS BIGINT), 0) AS dwellings
FROM panel p LEFT JOIN supplier ON s_suppkey = p.loc AND s_acctbal > 5000""")
def housing_join(spark, sf):
    d = lookup.dimension_join(s.panel(spark, sf), s.housing(spark, sf), "loc", ["AREA_NAME"])
    return d.select("loc", "year", "month", "x", "dwellings")


@query("recode_average", f"""WITH {s.CHANGES_SQL} SELECT new_code AS loc, round(avg(s_acctbal), 6) AS s_acctbal,
  round(avg(s_nationkey), 6) AS s_nationkey FROM chg LEFT JOIN supplier ON s_suppkey = old_code GROUP BY new_code""")
def recode_average(spark, sf):
    numbers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    d = lookup.recode_average(numbers, s.changes(spark, sf), "s_suppkey", "old_code", "new_code")
    return d.select("loc", r6("s_acctbal", "s_acctbal"), r6("s_nationkey", "s_nationkey"))


@query("map_first_match", f"""WITH {s.CHANGES_SQL}, m AS (SELECT old_code, min(new_code) AS new_code FROM chg GROUP BY old_code)
SELECT l_suppkey, l_partkey, count(*) AS n, any_value(m.new_code) AS new_code FROM lineitem
LEFT JOIN m ON m.old_code = l_partkey GROUP BY ALL""")
def map_first_match(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    d = lookup.map_first_match(li, s.changes(spark, sf), "l_partkey", "old_code", "new_code")
    return d.groupBy("l_suppkey", "l_partkey", "new_code").agg(F.count("*").alias("n"))


@query("neighbor_self_join", f"""WITH {PANEL}, {s.EDGES_SQL}
SELECT p.loc, p.year, p.month, p.x, e.neighbor, e.neighbor_rank, q.x AS x_neighbor
FROM panel p LEFT JOIN edges e ON e.location = p.loc
LEFT JOIN panel q ON q.loc = e.neighbor AND q.year = p.year AND q.month = p.month""")
def neighbor_self_join(spark, sf):
    edges = s.edges(spark, sf)
    d = spatial.neighbor_self_join(s.panel(spark, sf), edges, "loc", "x")
    return d.select("loc", "year", "month", "x", "neighbor", "neighbor_rank", "x_neighbor")


@query("inner_merge_rate", f"""WITH {s.AREAS_SQL}, {EV}, c AS (SELECT a.ward_name AS borough, count(*) AS n_events
  FROM ev JOIN areas a ON a.loc = ev.loc GROUP BY ALL),
r AS (SELECT n_name AS borough, round(avg(c_acctbal), 6) AS rate FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT c.borough, c.n_events, r.rate FROM c JOIN r ON r.borough = c.borough""")
def inner_merge_rate(spark, sf):
    ev = s.events(spark, sf).join(s.areas(spark, sf), "loc")
    counts = p.count_by(ev.withColumnRenamed("ward_name", "borough"), "borough", count="n_events")
    return lookup.inner_rate(counts, rates(spark, sf), "borough")


def rates(spark, sf):
    """A rate per nation name."""
    return (table(spark, sf, "customer")
            .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .groupBy(F.col("n_name").alias("borough")).agg(r6(F.avg("c_acctbal"), "rate")))


@query("choropleth_join", f"""WITH {s.ev_sql('l_partkey')} SELECT p_partkey AS loc, p_name, count(e.loc) AS n_events
FROM part LEFT JOIN (SELECT loc FROM ev WHERE kind = 'N') e ON e.loc = p_partkey GROUP BY ALL""")
def choropleth_join(spark, sf):
    counts = p.count_by(s.events(spark, sf, "l_partkey").filter("kind = 'N'"), "loc", count="n_events")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("loc"), "p_name")
    return lookup.fill_missing_counts(parts, counts, "loc", "n_events")


# -- demographics ---------------------------------------------------------

@query("population_long", f"WITH {s.POP_SQL} SELECT loc, year, population, round(density, 4) AS population_density FROM pop")
def population_long(spark, sf):
    return s.population(spark, sf).select("loc", "year", "population", r6("population_density", "population_density", 4))


@query("extrapolate_years", f"""WITH {EV}, {s.POP_SQL}, {s.EXTRA_SQL}
SELECT loc, year, population, round(density, 4) AS population_density FROM extra""")
def extrapolate_years(spark, sf):
    pop = s.population(spark, sf)
    d = demo.extrapolate_years(pop, demo.missing_years(s.dated(spark, sf), pop), "loc")
    return d.select("loc", "year", "population", r6("population_density", "population_density", 4))


@query("land_use_class", f"""WITH {s.LAND_SQL}, {s.CHANGES_SQL}, m AS (SELECT old_code, min(new_code) AS new_code FROM chg
  WHERE chgind <> 'X' GROUP BY old_code)
SELECT c.loc, m.new_code AS current_code, round(share, 6) AS residential_pct_2018,
  round(top, 6) AS max_non_residential_pct, dominant AS is_residential_dominant,
  round(advantage, 6) AS residential_advantage FROM classes c JOIN m ON m.old_code = c.loc""")
def land_use_class(spark, sf):
    codes = s.changes(spark, sf).filter("chgind <> 'X'").select(
        F.col("old_code").alias("loc"), F.col("new_code").alias("current_code"))
    d = demo.classify_locations(s.land_cover(spark, sf), codes, s.RESIDENTIAL, "loc", "current_code")
    return d.select("loc", "current_code", *[r6(c, c) for c in ("residential_pct_2018", "max_non_residential_pct",
                                                                "residential_advantage")],
                    "is_residential_dominant")


@query("residential_stats", f"""WITH {s.LAND_SQL} SELECT round(avg(share), 6) AS avg_share,
  round(quantile_cont(share, 0.5), 6) AS median_share, count(CASE WHEN dominant THEN 1 END) AS n_flagged,
  count(*) AS n_total, round(avg(CASE WHEN dominant THEN advantage END), 6) AS avg_advantage,
  round(min(CASE WHEN dominant THEN advantage END), 6) AS min_advantage,
  round(max(CASE WHEN dominant THEN advantage END), 6) AS max_advantage,
  round(100.0::DOUBLE * count(CASE WHEN dominant THEN 1 END) / count(*), 6) AS pct_flagged FROM classes""")
def residential_stats(spark, sf):
    d = eda.residential_stats(s.classes(spark, sf))
    return d.select("n_flagged", "n_total", *[r6(c, c) for c in (
        "avg_share", "median_share", "avg_advantage", "min_advantage", "max_advantage", "pct_flagged")])


# -- sets -----------------------------------------------------------------

@query("union_snapshots", f"WITH {s.SNAP_SQL} SELECT loc, round(imd_score, 6) AS imd_score, a AS valid_from, b AS valid_to FROM snap")
def union_snapshots(spark, sf):
    return s.snapshots(spark, sf).select("loc", r6("imd_score", "imd_score"), "valid_from", "valid_to")


@query("intersect_locations", f"""WITH {EV}, {s.LAND_SQL} SELECT DISTINCT loc FROM ev
WHERE loc IN (SELECT loc FROM classes WHERE dominant)""")
def intersect_locations(spark, sf):
    ev = s.events(spark, sf)
    return lookup.allowed_locations(ev, "loc", s.classes(spark, sf), "loc")


@query("missing_years", f"""WITH {EV} SELECT DISTINCT year FROM ev WHERE year NOT IN (1995, 1996, 1997, 1998, 1999)""")
def missing_years(spark, sf):
    return demo.missing_years(s.dated(spark, sf), s.population(spark, sf))
