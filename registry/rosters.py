"""Allocation, nesting and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import calendar as cal
from arealis.operators import allocate, dashboard as dash, eda, tree
from arealis.plans import roster as plan

from . import standins as s
from .core import query, r6, table

PANEL = s.panel_sql()
BASE = f"{PANEL}, {s.AREAS_SQL}"

# Scores: all events per supplier and month, those of type R in full and the others by a quarter.
SCORES = """sc AS (SELECT loc, ym, sum(CASE WHEN kind = 'R' THEN 1.0 ELSE 0.25 END)::DOUBLE AS score FROM ev GROUP BY ALL),
grid AS (SELECT a.*, m.ym, coalesce(sc.score, 0) AS score FROM areas a CROSS JOIN mon m
  LEFT JOIN sc ON sc.loc = a.loc AND sc.ym = m.ym),
daily AS (SELECT *, CAST(CASE WHEN total > 0 THEN CASE WHEN score > 0 AND floor(round(score / total * 100, 9)) < 1
    THEN 1 ELSE floor(round(score / total * 100, 9)) END ELSE 0 END AS INTEGER) AS officers
  FROM (SELECT *, sum(score) OVER (PARTITION BY lad, ward, ym) AS total FROM grid))"""
# Events of each hour of the day.
COUNTS = ("100, 80, 50, 40, 150, 600, 1550, 2050, 1780, 1320, 980, 680, 520, 450, 480, 550, "
          "620, 780, 850, 830, 740, 705, 690, 500")
HOURS = f"""hrs AS (SELECT h.h, c / sum(c) OVER () AS f, row_number() OVER (ORDER BY c DESC, h.h) AS r
  FROM (SELECT unnest([{COUNTS}])::DOUBLE AS c, generate_subscripts([{COUNTS}], 1) - 1 AS h) h)"""
EVENT_HOURS = """hrs AS (SELECT h, CASE WHEN sum(n) OVER () > 0 THEN n::DOUBLE / sum(n) OVER () ELSE 1.0 / 24 END AS f,
  row_number() OVER (ORDER BY n DESC, h) AS r, n FROM (SELECT g.h, count(e.event_id) AS n
  FROM (SELECT unnest(generate_series(0, 23)) AS h) g LEFT JOIN events e ON hour(e.ts) = g.h GROUP BY g.h))"""
ALLOC = f"WITH {BASE}, {SCORES}"


def scores(spark, sf):
    weight = F.sum(F.when(F.col("kind") == "R", 1.0).otherwise(0.25))
    return s.events(spark, sf).groupBy("loc", F.col("ym").alias("month_key")).agg(weight.alias("score"))


def months(spark, sf):
    return s.events(spark, sf).select("ym").distinct()


def daily(spark, sf):
    return plan.daily_roster(s.areas(spark, sf), scores(spark, sf), months(spark, sf))


@query("hourly_profile", f"WITH {EVENT_HOURS} SELECT h AS hour, n FROM hrs WHERE n > 0")
def hourly_profile(spark, sf):
    d = allocate.hourly_counts(table(spark, sf, "events"), "ts")
    return d.select("hour", "n")


def event_hours(spark, sf):
    return allocate.hourly_fractions(
        allocate.hourly_counts(table(spark, sf, "events"), "ts"))


@query("hourly_fractions", f"WITH {EVENT_HOURS} SELECT h AS hour, n, round(f, 9) AS fraction, r AS rank FROM hrs")
def hourly_fractions(spark, sf):
    return event_hours(spark, sf).select("hour", "n", r6("fraction", "fraction", 9), "rank")


@query("allocate_daily", ALLOC + " SELECT lad, ward, loc, ym AS month_key, score, officers AS officers_assigned FROM daily")
def allocate_daily(spark, sf):
    return daily(spark, sf).select("lad", "ward", "loc", "month_key", "score", "officers_assigned")


@query("allocate_hourly_bump", ALLOC + f""", {HOURS},
a AS (SELECT d.loc, d.ym, d.officers, h.h, h.r, CAST(floor(d.officers * h.f) AS INTEGER) AS n FROM daily d CROSS JOIN hrs h)
SELECT loc, ym AS month_key, h AS hour, CASE WHEN officers > 0 AND sum(n) OVER (PARTITION BY loc, ym) = 0 AND r = 1
  THEN 1 ELSE n END AS officers_assigned, printf('%02d:00–%02d:59', h, h) AS hour_block FROM a""")
def allocate_hourly_bump(spark, sf):
    d = allocate.allocate_hourly_bump(daily(spark, sf), allocate.hour_profile())
    return d.select("loc", "month_key", "hour", "officers_assigned", "hour_block")


REMAINDER = """a AS (SELECT d.loc, d.ym, d.officers, h.h, h.r, CAST(floor(d.officers * h.f) AS INTEGER) AS n
  FROM daily d CROSS JOIN hrs h),
hourly AS (SELECT loc, ym, h, officers, CASE WHEN officers > 0 AND r <= officers - sum(n) OVER (PARTITION BY loc, ym)
  THEN n + 1 ELSE n END AS n FROM a)"""


@query("allocate_hourly_remainder", ALLOC + f""", {EVENT_HOURS}, {REMAINDER}
SELECT loc, ym AS month_key, h AS hour, n AS officers FROM hourly""")
def allocate_hourly_remainder(spark, sf):
    """With a profile taken from the events."""
    d = allocate.allocate_hourly_remainder(daily(spark, sf), allocate.profile_of(event_hours(spark, sf)))
    return d.select("loc", "month_key", F.posexplode("hourly").alias("hour", "officers"))


@query("borough_officer_summary", ALLOC + """ SELECT lad_name, CAST(sum(officers) AS BIGINT) AS total_officers,
  round(avg(score), 6) AS avg_prediction_score FROM daily GROUP BY ALL""")
def borough_officer_summary(spark, sf):
    return eda.borough_summary(daily(spark, sf)).select("lad_name", "total_officers",
                                                        r6("avg_prediction_score", "avg_prediction_score"))


# -- nesting --------------------------------------------------------------

@query("history_by_loc", f"WITH {PANEL} SELECT loc, ym AS month_key, x AS n FROM panel")
def history_by_loc(spark, sf):
    d = tree.history_by_location(s.panel(spark, sf), "loc", "x")
    return d.select("loc", F.explode("historical").alias("month_key", "n"))


FLAT = "lad::VARCHAR AS lad, lad_name, ward::VARCHAR AS ward, ward_name, loc::VARCHAR AS loc, loc_name"


@query("nest_hierarchy", f"""WITH {s.ev_sql()}, {s.AREAS_SQL} SELECT {FLAT} FROM areas
WHERE loc IN (SELECT loc FROM ev WHERE kind = 'R')""")
def nest_hierarchy(spark, sf):
    """Restricted to locations with events of one type; small parts are forced."""
    allowed = s.events(spark, sf).filter("kind = 'R'")
    nested = tree.nest_hierarchy(tree.area_table(s.areas(spark, sf), allowed), max_areas=7)
    return tree.flatten_tree(nested).drop("entry")


@query("flatten_tree", f"WITH {s.AREAS_SQL} SELECT {FLAT} FROM areas")
def flatten_tree(spark, sf):
    return tree.flatten_tree(tree.nest_hierarchy(tree.area_table(s.areas(spark, sf)))).drop("entry")


@query("nest_points", f"""WITH {s.ev_sql()}, t AS (SELECT loc, count(*) AS total, count(DISTINCT ym) AS n_months FROM ev GROUP BY loc)
SELECT ev.loc, ym AS month_key, lon, lat, count(*) AS n, t.total AS total_burglary_count, t.n_months
FROM ev JOIN t ON t.loc = ev.loc GROUP BY ALL""")
def nest_points(spark, sf):
    """Nested with small parts, then flattened back."""
    d = tree.nest_points(s.events(spark, sf), "loc", "ym", "lon", "lat", max_points=50)
    flat = d.select("loc", "total_burglary_count", F.size("months_with_data").cast("bigint").alias("n_months"),
                    F.explode("burglaries_by_month").alias("month_key", "points"))
    one = flat.select("loc", "total_burglary_count", "n_months", "month_key", F.explode("points").alias("pt"))
    return one.groupBy("loc", "month_key", F.col("pt.longitude").alias("lon"), F.col("pt.latitude").alias("lat"),
                       "total_burglary_count", "n_months").agg(F.count("*").alias("n"))


@query("attach_predictions", f"WITH {BASE}, {SCORES} SELECT a.loc::VARCHAR AS loc, sc.ym AS month_key, sc.score FROM areas a LEFT JOIN sc ON sc.loc = a.loc")
def attach_predictions(spark, sf):
    """Areas without predictions keep their entry."""
    maps = tree.month_map(scores(spark, sf), "loc", "month_key", "score", "predictions")
    nested = tree.nest_hierarchy(tree.attach(tree.area_table(s.areas(spark, sf)), maps), ["predictions"])
    flat = tree.flatten_tree(nested)
    return flat.select("loc", F.explode_outer("entry.predictions").alias("month_key", "score"))


@query("integrate_all", ALLOC + f""", {HOURS}, {REMAINDER}, h24 AS (SELECT loc, ym, any_value(officers) AS officers,
  sum(n)::BIGINT AS sum_hourly, max(CASE WHEN h = 7 THEN n END) AS officers_7 FROM hourly GROUP BY ALL)
SELECT h.loc::VARCHAR AS loc, h.ym AS month_key, h.officers AS daily, h.sum_hourly, h.officers_7,
  coalesce(p.x, 0) AS historical, sc.score AS prediction FROM h24 h
LEFT JOIN panel p ON p.loc = h.loc AND p.ym = h.ym LEFT JOIN sc ON sc.loc = h.loc AND sc.ym = h.ym""")
def integrate_all(spark, sf):
    history = tree.history_by_location(s.panel(spark, sf), "loc", "x")
    nested = plan.integrated_tree(tree.area_table(s.areas(spark, sf)), scores(spark, sf), history,
                                  months(spark, sf))
    e = F.col("entry")

    def month(d):
        """Values of one month, taken inside the entry: its maps are not copied to a row per month."""
        hourly = F.element_at(e["officer_assignments"]["hourly"], d["key"])
        return F.struct(
            d["key"].alias("month_key"), d["value"].alias("daily"),
            F.aggregate(hourly, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("sum_hourly"),
            hourly[7].alias("officers_7"),
            F.coalesce(F.try_element_at(e["historical"], d["key"]), F.lit(0)).alias("historical"),
            F.try_element_at(e["predictions"], d["key"]).alias("prediction"))

    entries = F.transform(F.map_entries(e["officer_assignments"]["daily"]), month)
    return tree.flatten_tree(nested).select("loc", F.explode(entries).alias("m")).select("loc", "m.*")


@query("tree_summary", f"""WITH {s.ev_sql()}, {s.AREAS_SQL} SELECT count(DISTINCT lad) AS n_lads, count(DISTINCT ev.loc) AS n_locations,
  count(*) AS n_events, min(ym) AS first_month, max(ym) AS last_month, count(DISTINCT ym) AS n_months
FROM ev JOIN areas a ON a.loc = ev.loc""")
def tree_summary(spark, sf):
    points = s.events(spark, sf).join(s.areas(spark, sf).select("lad", "loc"), "loc")
    return tree.tree_summary(points, "lad", "loc", "ym")


# -- dashboard ------------------------------------------------------------

@query("list_areas", f"""WITH {s.AREAS_SQL} SELECT 'lad' AS level, lad AS code, lad_name AS name FROM areas
UNION SELECT 'ward', ward, ward_name FROM areas UNION SELECT 'loc', loc, loc_name FROM areas""")
def list_areas(spark, sf):
    """Boroughs, the wards of every borough and the areas of every ward."""
    a = s.areas(spark, sf)
    rows = [dash.list_areas(a, level).select(F.lit(level).alias("level"), F.col("code").cast("bigint").alias("code"),
                                             "name") for level in ("lad", "ward", "loc")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("lookup_series", f"""WITH {BASE}, {SCORES},
top AS (SELECT loc FROM ev GROUP BY loc ORDER BY count(*) DESC, loc LIMIT 1)
SELECT p.loc, p.ym AS month_key, p.x AS historical, sc.score AS prediction
FROM panel p LEFT JOIN sc ON sc.loc = p.loc AND sc.ym = p.ym WHERE p.loc = (SELECT loc FROM top)""")
def lookup_series(spark, sf):
    """Both series of the busiest location."""
    code = eda.top_locations(s.events(spark, sf), "loc", 1).select("loc").scalar()
    long = s.panel(spark, sf).select("loc", cal.month_key(F.col("year"), F.col("month")).alias("month_key"),
                                     F.col("x").alias("historical"))
    preds = scores(spark, sf).withColumnRenamed("score", "prediction")
    return dash.lookup_series(long, "loc", code).join(dash.lookup_series(preds, "loc", code),
                                                      ["loc", "month_key"], "left")


@query("points_in_range", f"""WITH {s.ev_sql()} SELECT loc, ym, lon, lat, count(*) AS n FROM ev
WHERE ym BETWEEN '1996-03' AND '1999-10' GROUP BY ALL""")
def points_in_range(spark, sf):
    d = dash.points_in_range(s.events(spark, sf), "ym", "1996-03", "1999-10")
    return d.groupBy("loc", "ym", "lon", "lat").agg(F.count("*").alias("n"))


@query("months_with_data", f"WITH {s.ev_sql('l_partkey')} SELECT DISTINCT loc, ym, year::VARCHAR AS year FROM ev")
def months_with_data(spark, sf):
    return dash.months_with_data(s.events(spark, sf, "l_partkey"), "loc", "ym")


@query("area_flags", f"""WITH {BASE}, {SCORES} SELECT a.loc, a.loc_name, a.loc IN (SELECT loc FROM sc) AS has_predictions,
  a.loc IN (SELECT loc FROM daily WHERE officers > 2) AS has_officers,
  a.loc IN (SELECT loc FROM ev WHERE kind = 'A' AND lon > 0.09) AS has_points FROM areas a""")
def area_flags(spark, sf):
    a = s.areas(spark, sf).select("loc", "loc_name")
    points = s.events(spark, sf).filter("kind = 'A' AND lon > 0.09")
    return dash.area_flags(a, scores(spark, sf), daily(spark, sf).filter("officers_assigned > 2"), points)


@query("merged_timeline", """WITH d AS (SELECT user_id AS loc, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL),
h AS (SELECT loc, day, n FROM d WHERE day < '2024-01-21'), p AS (SELECT loc, day, n * 1.5::DOUBLE AS v FROM d WHERE day >= '2024-01-21'),
u AS (SELECT loc, day, n AS historical, NULL::DOUBLE AS prediction, 0 AS side FROM h WHERE loc IN (SELECT loc FROM p)
  UNION ALL SELECT loc, day, NULL, v, 1 FROM p),
f AS (SELECT * FROM u WHERE day BETWEEN '2024-01-10' AND '2024-01-28')
SELECT loc, day, historical, prediction, CASE WHEN min(side) OVER w < max(side) OVER w
  THEN min(CASE WHEN side = 1 THEN day END) OVER w END AS prediction_start FROM f WINDOW w AS (PARTITION BY loc)""")
def merged_timeline(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("user_id").alias("loc"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"))
    history = d.filter("day < '2024-01-21'").withColumnRenamed("n", "historical")
    preds = d.filter("day >= '2024-01-21'").select("loc", "day", (F.col("n") * 1.5).alias("prediction"))
    return dash.merged_timeline(history, preds, "loc", "day", "2024-01-10", "2024-01-28")


@query("officers_by_hour", ALLOC + f""", {HOURS}, {REMAINDER} SELECT loc, ym AS month_key, h AS hour, n AS officers FROM hourly
WHERE ym = (SELECT max(ym) FROM ev)""")
def officers_by_hour(spark, sf):
    d = allocate.allocate_hourly_remainder(daily(spark, sf), allocate.hour_profile())
    last = s.events(spark, sf).select(F.max("ym")).scalar()
    return dash.officers_by_hour(d, "loc", "month_key", month_key=last)
