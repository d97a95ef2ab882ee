"""Calendar, counts, grid and descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import calendar as cal
from arealis.operators.skew import exact_quantiles
from arealis.operators import eda, lookup, panel as p

from . import standins as s
from .core import query, r6, table

EV = s.ev_sql()
PANEL = s.panel_sql()


@query("normalize_time", f"""WITH {EV}, {s.TIME_SQL}
SELECT e.loc, e.ym, e.year, e.month, round(n.month_sin, 6) AS month_sin,
  round(n.month_cos, 6) AS month_cos, round(n.tin, 6) AS time_index_norm, count(*) AS n
FROM ev e JOIN norm n ON n.year = e.year AND n.month = e.month GROUP BY ALL""")
def normalize_time(spark, sf):
    """Checked on the distinct rows with their multiplicity."""
    cols = ["loc", "ym", "year", "month"]
    d = s.dated(spark, sf).groupBy(*cols, "month_sin", "month_cos", "time_index_norm").agg(
        F.count("*").alias("n"))
    return d.select(*cols, *[r6(c, c) for c in ("month_sin", "month_cos", "time_index_norm")], "n")


@query("holiday_month", f"""WITH {EV}
SELECT month, month IN (4, 7, 8, 10, 12) AS holiday_month, count(*) AS n FROM ev GROUP BY ALL""")
def holiday_month(spark, sf):
    return s.dated(spark, sf).groupBy("month", cal.holiday_month(F.col("month")).alias("holiday_month")).agg(
        F.count("*").alias("n"))


@query("month_sequence", f"""WITH {EV}, ends AS (SELECT loc, max(ym) AS last FROM ev GROUP BY loc)
SELECT loc, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month FROM (
  SELECT loc, unnest(generate_series(DATE '2001-11-01', DATE '2002-10-01', INTERVAL 1 MONTH)) AS d FROM ends)""")
def month_sequence(spark, sf):
    locs = p.distinct_locations(s.events(spark, sf), "loc")
    days = locs.select("loc", F.explode(cal.month_sequence("2001-11", "2002-10")).alias("d"))
    return days.select("loc", F.year("d").alias("year"), F.month("d").alias("month"))


@query("parse_year_month", """WITH t AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN
    strftime(o_orderdate, '%Y') || '-' || CAST(month(o_orderdate) + 6 AS VARCHAR)
    ELSE strftime(o_orderdate, '%Y-%m') END AS ym FROM orders)
SELECT ym, CASE WHEN CAST(split_part(ym, '-', 2) AS INTEGER) BETWEEN 1 AND 12
    THEN CAST(split_part(ym, '-', 1) AS INTEGER) END AS year,
  CASE WHEN CAST(split_part(ym, '-', 2) AS INTEGER) BETWEEN 1 AND 12
    THEN CAST(split_part(ym, '-', 2) AS INTEGER) END AS month, count(*) AS n FROM t GROUP BY ALL""")
def parse_year_month(spark, sf):
    """Some texts get an impossible month."""
    o = table(spark, sf, "orders")
    ym = F.when(F.col("o_orderpriority") == "5-LOW", F.concat_ws(
        "-", F.year("o_orderdate"), F.month("o_orderdate") + 6)).otherwise(
        F.date_format("o_orderdate", "yyyy-MM"))
    got = o.select(ym.alias("ym")).withColumn("p", cal.year_month(F.col("ym")))
    return got.groupBy("ym", F.col("p.year").alias("year"), F.col("p.month").alias("month")).agg(
        F.count("*").alias("n"))


@query("month_key", f"""WITH {EV} SELECT year, month, ym AS month_key, count(*) AS n FROM ev GROUP BY ALL""")
def month_key(spark, sf):
    return s.dated(spark, sf).groupBy("year", "month", cal.month_key(F.col("year"), F.col("month"))
                                      .alias("month_key")).agg(F.count("*").alias("n"))


@query("count_by_loc_month", f"""WITH {s.ev_sql('l_partkey')}
SELECT loc, year, month, count(*) AS x FROM ev GROUP BY ALL""")
def count_by_loc_month(spark, sf):
    return p.count_by(s.dated(spark, sf, "l_partkey"), "loc", "year", "month", count="x")


@query("count_by_month", f"""WITH {EV}, {s.LAND_SQL}
SELECT ym, count(*) AS n_all, count(CASE WHEN c.dominant THEN 1 END) AS n_residential
FROM ev JOIN classes c ON c.loc = ev.loc GROUP BY ym""")
def count_by_month(spark, sf):
    ev = s.events(spark, sf)
    everything = p.count_by(ev, "ym", count="n_all")
    inside = p.count_by(lookup.semi_filter(ev, "loc", s.classes(spark, sf), "loc"), "ym",
                        count="n_residential")
    return lookup.fill_missing_counts(everything, inside, "ym", "n_residential").orderBy("ym")


@query("densify_grid", f"""WITH {PANEL}, {s.TIME_SQL}
SELECT p.loc, p.year, p.month, round(n.month_sin, 6) AS month_sin, round(n.month_cos, 6) AS month_cos,
  round(n.tin, 6) AS time_index_norm, p.x FROM panel p JOIN norm n ON n.year = p.year AND n.month = p.month""")
def densify_grid(spark, sf):
    return s.panel(spark, sf).select("loc", "year", "month", *[
        r6(c, c) for c in ("month_sin", "month_cos", "time_index_norm")], "x")


@query("densify_grid_calendar", """WITH ev AS (SELECT o_custkey AS loc, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders),
span AS (SELECT min(year * 12 + month - 1) AS lo, max(year * 12 + month - 1) AS hi FROM ev),
axis AS (SELECT unnest(generate_series(lo, hi)) AS k FROM span)
SELECT l.loc, CAST(k // 12 AS INTEGER) AS year, CAST(k % 12 + 1 AS INTEGER) AS month, count(e.loc) AS x
FROM (SELECT DISTINCT loc FROM ev) l CROSS JOIN axis
LEFT JOIN ev e ON e.loc = l.loc AND e.year * 12 + e.month - 1 = k GROUP BY ALL""")
def densify_grid_calendar(spark, sf):
    """Months nobody has are filled too."""
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("loc"), F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
    return p.densify_grid(p.normalize_time(o, "ym"), "loc", "x", calendar=True).select("loc", "year", "month", "x")


@query("distinct_keys", f"""WITH {s.ev_sql('l_partkey')}
SELECT 'loc' AS kind, count(*) AS n FROM (SELECT DISTINCT loc FROM ev)
UNION ALL SELECT 'month', count(*) FROM (SELECT DISTINCT year, month FROM ev)""")
def distinct_keys(spark, sf):
    d = s.dated(spark, sf, "l_partkey")
    locs = p.distinct_locations(d, "loc").select(F.lit("loc").alias("kind"))
    months = p.distinct_months(d).select(F.lit("month").alias("kind"))
    return locs.unionByName(months).groupBy("kind").agg(F.count("*").alias("n"))


@query("top_locations", f"""WITH {s.ev_sql('l_partkey')}
SELECT loc, count(*) AS n_events FROM ev GROUP BY loc ORDER BY n_events DESC, loc LIMIT 10""")
def top_locations(spark, sf):
    return eda.top_locations(s.events(spark, sf, "l_partkey"), "loc", 10)


@query("basic_stats", f"""WITH {EV}, m AS (SELECT ym, count(*) AS n FROM ev GROUP BY ym)
SELECT CAST((SELECT count(*) FROM ev) AS BIGINT) AS total_events, min(ym) AS first_date, max(ym) AS last_date,
  (SELECT count(DISTINCT loc) FROM ev) AS n_locations, round(avg(n), 6) AS avg_per_month,
  round(stddev_samp(n), 6) AS std_per_month FROM m""")
def basic_stats(spark, sf):
    b = eda.basic_stats(s.events(spark, sf), "loc", "ym")
    return b.select("total_events", "first_date", "last_date", "n_locations",
                    r6("avg_per_month", "avg_per_month"), r6("std_per_month", "std_per_month"))


@query("year_month_pivot", f"""WITH {EV} SELECT year, """ + ", ".join(
    f"nullif(count(CASE WHEN month = {m} THEN 1 END), 0) AS m{m}" for m in range(1, 13))
    + " FROM ev GROUP BY year")
def year_month_pivot(spark, sf):
    return eda.year_month_pivot(s.dated(spark, sf))


NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
NAMES = ("l_returnflag", "l_linestatus", "l_shipdate")


@query("describe_table", " UNION ALL ".join([f"""SELECT '{c}' AS column_name, count({c}) AS n,
  count(*) - count({c}) AS n_null, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75,
  round(max({c})::DOUBLE, 6) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM lineitem"""
    for c in NUMBERS] + [f"""SELECT '{c}', count({c}), count(*) - count({c}),
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, min({c})::VARCHAR, max({c})::VARCHAR FROM lineitem""" for c in NAMES]))
def describe_table(spark, sf):
    d = eda.describe_table(table(spark, sf, "lineitem"), [*NUMBERS, *NAMES])
    return d.select("column_name", "n", "n_null", r6("mean", "mean", 5), r6("std", "std", 4),
                    *[r6(c, c) for c in ("min", "p25", "p50", "p75", "max")], "min_text", "max_text")


# One value in seventeen is infinite or no number; these have their ranks too.
@query("describe_not_finite", """WITH d AS (SELECT CASE WHEN l_orderkey % 51 = 0 THEN 'NaN'::DOUBLE WHEN l_orderkey % 51 = 17 THEN 'Infinity'::DOUBLE
  WHEN l_orderkey % 51 = 34 THEN '-Infinity'::DOUBLE ELSE l_extendedprice END AS x FROM lineitem),
r AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS r, count(*) OVER () - 1 AS n FROM d)
SELECT q, max(CASE WHEN r = floor(q * n) THEN x END)
  + CASE WHEN max(CASE WHEN r = floor(q * n) THEN x END) = max(CASE WHEN r = ceil(q * n) THEN x END) THEN 0
    ELSE (max(CASE WHEN r = ceil(q * n) THEN x END) - max(CASE WHEN r = floor(q * n) THEN x END)) * (any_value(q * n) - floor(any_value(q * n))) END AS v
FROM r CROSS JOIN (SELECT unnest([0.0::DOUBLE, 0.25, 0.5, 0.75, 0.97, 1.0]) AS q) GROUP BY q""")
def describe_not_finite(spark, sf):
    key = F.col("l_orderkey") % 51
    x = (F.when(key == 0, float("nan")).when(key == 17, float("inf")).when(key == 34, float("-inf"))
         .otherwise(F.col("l_extendedprice")))
    probs = (0.0, 0.25, 0.5, 0.75, 0.97, 1.0)
    found = exact_quantiles(table(spark, sf, "lineitem").select(x.alias("x")), ["x"], probs)["x"]
    return spark.createDataFrame(list(zip(probs, found)), "q double, v double")


@query("max_normalise", f"""WITH {EV}, m AS (SELECT ym, count(*) AS n FROM ev GROUP BY ym)
SELECT ym, n, round(n::DOUBLE / (SELECT max(n) FROM m), 6) AS share FROM m""")
def max_normalise(spark, sf):
    m = p.count_by(s.events(spark, sf), "ym", count="n")
    return eda.max_normalise(m, "n", "share").select("ym", "n", r6("share", "share"))


@query("log_counts", f"""WITH {s.ev_sql('l_partkey')}, c AS (SELECT p_partkey AS loc, count(e.loc) AS n
  FROM part LEFT JOIN (SELECT loc FROM ev WHERE kind = 'R') e ON e.loc = p_partkey GROUP BY p_partkey)
SELECT loc, n, round(ln(1 + n::DOUBLE), 6) AS log1p_count,
  CASE WHEN n > 0 THEN round(log2(n::DOUBLE), 6) END AS log2_count FROM c""")
def log_counts(spark, sf):
    kind = s.events(spark, sf, "l_partkey").filter("kind = 'R'")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("loc"))
    n = lookup.fill_missing_counts(parts, p.count_by(kind, "loc", count="n"), "loc", "n")
    return eda.log_counts(n, "n").select("loc", "n", r6("log1p_count", "log1p_count"),
                                         r6("log2_count", "log2_count"))


@query("hierarchy_counts", f"""WITH {s.AREAS_SQL}, {s.CHANGES_SQL},
j AS (SELECT a.*, c.chgind, c.new_code FROM areas a LEFT JOIN chg c ON c.old_code = a.loc),
f AS (SELECT *, (lad_name LIKE 'A%' OR ward_name LIKE '%_1%' ESCAPE '!') AS inside FROM j),
n AS (SELECT count(DISTINCT loc) AS n_loc, count(DISTINCT ward) AS n_ward, count(DISTINCT lad) AS n_lad,
  count(DISTINCT CASE WHEN chgind = 'U' THEN loc END) AS n_unchanged,
  count(DISTINCT CASE WHEN inside THEN loc END) AS sub_n_loc,
  count(DISTINCT CASE WHEN inside THEN ward END) AS sub_n_ward,
  count(DISTINCT CASE WHEN inside THEN lad END) AS sub_n_lad,
  count(DISTINCT CASE WHEN inside AND chgind = 'U' THEN loc END) AS sub_n_unchanged FROM f)
SELECT *, round(sub_n_loc::DOUBLE / n_loc, 6) AS share_loc, round(sub_n_ward::DOUBLE / n_ward, 6) AS share_ward,
  round(sub_n_lad::DOUBLE / n_lad, 6) AS share_lad FROM n""".replace("'%_1%' ESCAPE '!'", "'%!_1%' ESCAPE '!'"))
def hierarchy_counts(spark, sf):
    j = s.areas(spark, sf).join(s.changes(spark, sf), F.col("loc") == F.col("old_code"), "left")
    inside = F.col("lad_name").startswith("A") | F.col("ward_name").contains("_1")
    d = eda.hierarchy_counts(j, ["loc", "ward", "lad"], ("loc", "chgind", "U"), inside)
    counts = [c for c in d.columns if not c.startswith("share")]
    return d.select(*counts, *[r6(f"share_{c}", f"share_{c}") for c in ("loc", "ward", "lad")])
