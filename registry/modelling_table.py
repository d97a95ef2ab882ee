"""The whole modelling table: events to features, dimensions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.plans.feature_table import build_features

from . import standins as s, windows as w
from .core import query, r6

NUMBERS = ["time_index_norm", *w.FEATURES, "neighbor_x_avg", "neighbor_x_std", "neighbor_x_weighted_avg",
           "imd_score"]

SQL = f"""WITH RECURSIVE {s.panel_sql().replace('panel AS (', 'panel0 AS (')}, {s.TIME_SQL}, {s.LAND_SQL}, {s.EDGES_SQL},
{s.POP_SQL}, {s.EXTRA_SQL}, {s.SNAP_SQL},
nj AS (SELECT p.loc, p.year, p.month, q.x AS c, e.distance, e.neighbor_rank FROM panel0 p
  LEFT JOIN edges e ON e.location = p.loc
  LEFT JOIN panel0 q ON q.loc = e.neighbor AND q.year = p.year AND q.month = p.month),
nb AS (SELECT loc, year, month, round(avg(c), 6) AS neighbor_x_avg, max(c) AS neighbor_x_max,
  round(stddev_samp(c), 6) AS neighbor_x_std,
  round(coalesce(sum(c / (distance + 100)), 0) / sum(1 / (distance + 100)), 6) AS neighbor_x_weighted_avg,
  max(CASE WHEN neighbor_rank = 1 THEN c END) AS closest_neighbor_x FROM nj GROUP BY ALL),
panel AS (SELECT loc, year, month, ym, x, row_number() OVER (PARTITION BY loc ORDER BY year, month) - 1 AS t FROM panel0
  WHERE year >= 1996 AND loc IN (SELECT loc FROM classes WHERE dominant)),
{w.EWM_CTE}, {w.HULL_CTE}, feats AS ({w.ALL_SELECT}),
pops AS (SELECT loc, year, population, density FROM pop UNION ALL SELECT loc, year, population, density FROM extra)
SELECT f.*, round(n.tin, 6) AS time_index_norm, f.month IN (4, 7, 8, 10, 12) AS holiday_month,
  nb.neighbor_x_avg, nb.neighbor_x_max, nb.neighbor_x_std, nb.neighbor_x_weighted_avg, nb.closest_neighbor_x,
  pops.population, round(pops.density, 4) AS population_density, round(sn.imd_score, 6) AS imd_score,
  coalesce(CAST(round(sp.s_acctbal) AS BIGINT), 0) AS dwellings
FROM feats f JOIN norm n ON n.year = f.year AND n.month = f.month
LEFT JOIN nb ON nb.loc = f.loc AND nb.year = f.year AND nb.month = f.month
LEFT JOIN pops ON pops.loc = f.loc AND pops.year = f.year
LEFT JOIN snap sn ON sn.loc = f.loc AND f.year BETWEEN sn.a AND sn.b
LEFT JOIN supplier sp ON sp.s_suppkey = f.loc AND sp.s_acctbal > 5000"""


@query("feature_table", SQL)
def feature_table(spark, sf):
    d = build_features(
        s.events(spark, sf), target="x", date_col="ym", population=s.population(spark, sf),
        snapshots=s.snapshots(spark, sf), housing=s.housing(spark, sf).drop("AREA_NAME"),
        edges=s.edges(spark, sf),
        classes=s.classes(spark, sf), class_key="loc")
    return d.drop("month_sin", "month_cos").select(*[
        r6(c, c) if c in NUMBERS else r6(c, c, 4) if c == "population_density" else F.col(c)
        for c in d.columns if c not in ("month_sin", "month_cos")])
