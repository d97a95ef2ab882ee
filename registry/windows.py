"""Time-series features on the sparse part-by-month panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import series as ser
from arealis.functions.scalars import safe_div
from arealis.operators import cleaning, temporal as t

from . import standins as s
from .core import query, r6, table

ORDER = ["year", "month"]
PANEL = s.panel_sql("l_partkey")
W = "(PARTITION BY loc ORDER BY t)"
KEYS = ["loc", "year", "month"]


def panel(spark, sf):
    return s.panel(spark, sf, "l_partkey").select(*KEYS, "x")


def frame(agg: str, a: int, b: int) -> str:
    """Aggregate over rows t-a..t-b, NULL unless all rows exist."""
    over = f"OVER (PARTITION BY loc ORDER BY t ROWS BETWEEN {a} PRECEDING AND {b} PRECEDING)"
    return f"CASE WHEN count(x) {over} = {a - b + 1} THEN {agg}(x) {over} END"


def window():
    return ser.series_window("loc", *ORDER)


@query("lag_features", f"""WITH {PANEL} SELECT loc, year, month, """ + ", ".join(
    f"lag(x, {k}) OVER {W} AS x_lag_{k}" for k in (1, 3, 6, 12)) + " FROM panel")
def lag_features(spark, sf):
    return t.add_lags(panel(spark, sf), "loc", "x", ORDER).drop("x")


EWM_CTE = """e AS (SELECT loc, t, x::DOUBLE AS e6, x::DOUBLE AS e12, x::DOUBLE AS a, x::DOUBLE AS b, x::DOUBLE AS c
  FROM panel WHERE t = 0
  UNION ALL
  SELECT p.loc, p.t, e.e6 * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * p.x,
    e.e12 * (1 - 2.0::DOUBLE / 13) + 2.0::DOUBLE / 13 * p.x,
    e.a * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * p.x,
    e.b * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * (e.a * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * p.x),
    e.c * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * (e.b * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7
      * (e.a * (1 - 2.0::DOUBLE / 7) + 2.0::DOUBLE / 7 * p.x))
  FROM e JOIN panel p ON p.loc = e.loc AND p.t = e.t + 1)"""
EWM_SQL = f"WITH RECURSIVE {PANEL}, {EWM_CTE}"


@query("ewm_mean", EWM_SQL + """ SELECT p.loc, p.year, p.month, round(e.e6, 6) AS x_ewm_6,
  round(e.e12, 6) AS x_ewm_12 FROM panel p LEFT JOIN e ON e.loc = p.loc AND e.t = p.t - 1""")
def ewm_mean(spark, sf):
    d = t.add_ewm(panel(spark, sf), "loc", "x", ORDER)
    return d.select(*KEYS, r6("x_ewm_6", "x_ewm_6"), r6("x_ewm_12", "x_ewm_12"))


# Weights of more than 300 rows back are below 1e-16 for both spans.
LONG_SQL = """WITH s AS (SELECT l_returnflag AS loc, l_orderkey, l_linenumber, l_quantity::DOUBLE AS x,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS t FROM lineitem),
e AS (SELECT a.loc, a.t, a.l_orderkey, a.l_linenumber,
  sum(b.x * power(5.0::DOUBLE / 7, a.t - 1 - b.t) * CASE WHEN b.t = 0 THEN 1 ELSE 2.0::DOUBLE / 7 END) AS e6,
  sum(b.x * power(11.0::DOUBLE / 13, a.t - 1 - b.t) * CASE WHEN b.t = 0 THEN 1 ELSE 2.0::DOUBLE / 13 END) AS e12
  FROM s a LEFT JOIN (SELECT s.*, unnest(generate_series(1, 300)) AS k FROM s) b ON b.loc = a.loc AND b.t + b.k = a.t
  GROUP BY ALL)
SELECT loc, l_orderkey, l_linenumber, round(e6, 6) AS x_ewm_6, round(e12, 6) AS x_ewm_12 FROM e"""


@query("ewm_mean_long_series", LONG_SQL)
def ewm_mean_long_series(spark, sf):
    """Three series of many thousand rows each."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    d = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("loc"), *order, F.col("l_quantity").alias("x"))
    d = t.add_ewm(d, "loc", "x", order, long=True)
    return d.select("loc", "l_orderkey", "l_linenumber", r6("x_ewm_6", "x_ewm_6"), r6("x_ewm_12", "x_ewm_12"))


@query("tema", EWM_SQL + """ SELECT p.loc, p.year, p.month,
  round(CASE WHEN e.loc IS NOT NULL THEN greatest(3 * e.a - 3 * e.b + e.c, 0.0) END, 6) AS x_tema_6
  FROM panel p LEFT JOIN e ON e.loc = p.loc AND e.t = p.t - 1""")
def tema(spark, sf):
    d = t.add_tema(panel(spark, sf), "loc", "x", ORDER)
    return d.select(*KEYS, r6("x_tema_6", "x_tema_6"))


@query("wma", f"""WITH {PANEL} SELECT loc, year, month,
  round((2.0 * x + lag(x, 1) OVER {W}) / 3, 6) AS wma_2,
  round((4.0 * x + 3 * lag(x, 1) OVER {W} + 2 * lag(x, 2) OVER {W} + lag(x, 3) OVER {W}) / 10, 6) AS wma_4
  FROM panel""")
def wma(spark, sf):
    w = window()
    return panel(spark, sf).select(*KEYS, r6(ser.wma(F.col("x"), 2, w), "wma_2"),
                                   r6(ser.wma(F.col("x"), 4, w), "wma_4"))


HULL_CTE = f"""h AS (SELECT *, (2.0::DOUBLE * x + lag(x, 1) OVER {W}) / 3 AS w2,
  (4.0::DOUBLE * x + 3 * lag(x, 1) OVER {W} + 2 * lag(x, 2) OVER {W} + lag(x, 3) OVER {W}) / 10 AS w4,
  (5.0::DOUBLE * x + 4 * lag(x, 1) OVER {W} + 3 * lag(x, 2) OVER {W} + 2 * lag(x, 3) OVER {W}
    + lag(x, 4) OVER {W}) / 15 AS w5 FROM panel),
g AS (SELECT *, 2 * w2 - w4 AS d4, 2 * w2 - w5 AS d5 FROM h),
hull AS (SELECT *, (2 * lag(d4, 1) OVER {W} + lag(d4, 2) OVER {W}) / 3 AS r4,
  (2 * lag(d5, 1) OVER {W} + lag(d5, 2) OVER {W}) / 3 AS r5 FROM g)"""
HULL_SQL = f"{PANEL}, {HULL_CTE}"


@query("hma", f"""WITH {HULL_SQL} SELECT loc, year, month,
  round(CASE WHEN r4 < 0 THEN 0 ELSE r4 END, 6) AS x_hma_4,
  round(CASE WHEN r5 < 0 THEN 0 ELSE r5 END, 6) AS x_hma_5 FROM hull""")
def hma(spark, sf):
    d = t.add_hull(panel(spark, sf), "loc", "x", ORDER)
    return d.select(*KEYS, r6("x_hma_4", "x_hma_4"), r6("x_hma_5", "x_hma_5"))


@query("rolling_sum_12", f"""WITH {PANEL} SELECT loc, year, month,
  CAST({frame('sum', 12, 1)} AS BIGINT) AS x_sum_12 FROM panel""")
def rolling_sum_12(spark, sf):
    return panel(spark, sf).select(*KEYS, ser.rolling_sum(F.col("x"), 12, window()).alias("x_sum_12"))


ACTIVE_SQL = f"CASE WHEN t > 0 THEN CASE WHEN coalesce({frame('sum', 3, 1)}, 0) > 0 THEN 1 ELSE 0 END END"


@query("active_3", f"WITH {PANEL} SELECT loc, year, month, {ACTIVE_SQL} AS x_active_3 FROM panel")
def active_3(spark, sf):
    return panel(spark, sf).select(*KEYS, ser.active(F.col("x"), 3, window()).alias("x_active_3"))


PCT_SQL = f"(lag(x, 3) OVER {W} - lag(x, 6) OVER {W})::DOUBLE / nullif(lag(x, 6) OVER {W}, 0)"


@query("pct_change", f"WITH {PANEL} SELECT loc, year, month, round({PCT_SQL}, 6) AS x_pct_change FROM panel")
def pct_change(spark, sf):
    return panel(spark, sf).select(*KEYS, r6(ser.pct_change(F.col("x"), 3, 6, window()), "x_pct_change"))


VOL_SQL = f"{frame('stddev_samp', 8, 3)} / nullif({frame('avg', 8, 3)}, 0)"


@query("volatility_6m", f"WITH {PANEL} SELECT loc, year, month, round({VOL_SQL}, 6) AS x_volatility_6m FROM panel")
def volatility_6m(spark, sf):
    return panel(spark, sf).select(*KEYS, r6(ser.volatility(F.col("x"), 6, window(), 3), "x_volatility_6m"))


TREND_SQL = f"{frame('avg', 5, 3)} / nullif({frame('avg', 11, 9)}, 0)"


@query("trend_ratio", f"WITH {PANEL} SELECT loc, year, month, round({TREND_SQL}, 6) AS x_trend_ratio FROM panel")
def trend_ratio(spark, sf):
    return panel(spark, sf).select(*KEYS, r6(ser.trend_ratio(F.col("x"), 3, window(), 3, 9), "x_trend_ratio"))


@query("safe_div", f"""WITH {PANEL} SELECT loc, year, month,
  round((lag(x, 1) OVER {W})::DOUBLE / nullif(x, 0), 6) AS ratio FROM panel""")
def safe_div_query(spark, sf):
    return panel(spark, sf).select(*KEYS, r6(safe_div(ser.lagged(F.col("x"), 1, window()), F.col("x")), "ratio"))


RISK_SQL = "0.134::DOUBLE * (" + " + ".join(
    f"coalesce(lag(x, {k}) OVER {W}, 0) * greatest(0.106::DOUBLE * power({k}::DOUBLE, -0.383::DOUBLE) - 0.018::DOUBLE, 0.0::DOUBLE)"
    for k in range(1, 25)) + ")"


@query("revictimization_risk", f"""WITH {PANEL} SELECT loc, year, month,
  round({RISK_SQL}, 6) AS revictimization_risk FROM panel""")
def revictimization_risk(spark, sf):
    d = t.add_repeat_risk(panel(spark, sf), "loc", "x", ORDER)
    return d.select(*KEYS, r6("revictimization_risk", "revictimization_risk"))


FEATURES = ["x_ewm_6", "x_ewm_12", "x_tema_6", "x_hma_4", "x_hma_5", "x_pct_change", "x_volatility_6m",
            "x_trend_ratio", "revictimization_risk"]
ALL_SELECT = f"""SELECT p.loc, p.year, p.month, p.x,
  lag(p.x, 1) OVER w AS x_lag_1, lag(p.x, 3) OVER w AS x_lag_3, lag(p.x, 6) OVER w AS x_lag_6,
  lag(p.x, 12) OVER w AS x_lag_12, round(e.e6, 6) AS x_ewm_6, round(e.e12, 6) AS x_ewm_12,
  round(CASE WHEN e.loc IS NOT NULL THEN greatest(3 * e.a - 3 * e.b + e.c, 0.0) END, 6) AS x_tema_6,
  round(CASE WHEN r4 < 0 THEN 0 ELSE r4 END, 6) AS x_hma_4,
  round(CASE WHEN r5 < 0 THEN 0 ELSE r5 END, 6) AS x_hma_5, f.x_sum_12, f.x_active_3, f.x_pct_change,
  f.x_volatility_6m, f.x_trend_ratio, f.revictimization_risk
  FROM hull p LEFT JOIN e ON e.loc = p.loc AND e.t = p.t - 1
  JOIN (SELECT loc, t, CAST({frame('sum', 12, 1)} AS BIGINT) AS x_sum_12, {ACTIVE_SQL} AS x_active_3,
    round({PCT_SQL}, 6) AS x_pct_change, round({VOL_SQL}, 6) AS x_volatility_6m,
    round({TREND_SQL}, 6) AS x_trend_ratio, round({RISK_SQL}, 6) AS revictimization_risk FROM panel) f
    ON f.loc = p.loc AND f.t = p.t
  WINDOW w AS (PARTITION BY p.loc ORDER BY p.t)"""
ALL_SQL = f"WITH RECURSIVE {PANEL}, {EWM_CTE}, {HULL_CTE} {ALL_SELECT}"


@query("temporal_features", ALL_SQL)
def temporal_features(spark, sf):
    """Flagship: panel with every temporal feature."""
    d = t.add_temporal_features(panel(spark, sf), "loc", "x", ORDER, risk=True)
    return d.select(*[r6(c, c) if c in FEATURES else F.col(c) for c in d.columns])


@query("naive_forecast", f"""WITH {s.ev_sql('l_partkey')}, m AS (SELECT loc, ym, count(*) AS n FROM ev GROUP BY ALL)
SELECT m.loc, arg_max(m.n, m.ym) AS predicted, any_value(p.p_name) AS name
FROM m LEFT JOIN part p ON p.p_partkey = m.loc GROUP BY m.loc""")
def naive_forecast(spark, sf):
    from .core import table

    names = cleaning.dedup_first(table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name")),
                                 ["p_partkey"])
    return t.naive_forecast(s.events(spark, sf, "l_partkey"), "loc", "ym", names, "p_partkey")


@query("last_row_per_loc", f"""WITH {PANEL} SELECT loc, year, month, x FROM panel
QUALIFY row_number() OVER (PARTITION BY loc ORDER BY year DESC, month DESC) = 1""")
def last_row_per_loc(spark, sf):
    return t.last_row_per_location(panel(spark, sf), "loc", ORDER)
