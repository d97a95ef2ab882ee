"""Regression statistics and smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import calendar as cal
from arealis.operators import panel as p, stats

from . import standins as s
from .core import query, r6, table
from .sources_joins import rates


@query("pearson_corr", f"""WITH {s.AREAS_SQL}, {s.ev_sql()}, c AS (SELECT a.ward_name AS borough, count(*) AS n_events
  FROM ev JOIN areas a ON a.loc = ev.loc GROUP BY ALL),
r AS (SELECT n_name AS borough, round(avg(c_acctbal), 6) AS rate FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT round(corr(n_events, rate), 6) AS corr FROM c JOIN r ON r.borough = c.borough""")
def pearson_corr(spark, sf):
    ev = s.events(spark, sf).join(s.areas(spark, sf), "loc").withColumnRenamed("ward_name", "borough")
    j = p.count_by(ev, "borough", count="n_events").join(rates(spark, sf), "borough")
    return stats.pearson(j, "n_events", "rate").select(r6("corr", "corr"))


OLS_COLS = ["coef", "se", "z", "p_value", "r_squared"]


@query("ols_hc3", """WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
g AS (SELECT count(*) AS n, avg(x) AS mx, regr_sxx(y, x) AS sxx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
  regr_r2(y, x) AS r2 FROM d),
e AS (SELECT x - mx AS dx, 1.0::DOUBLE / n - mx * (x - mx) / sxx AS w, sxx,
  power((y - a - b * x) / (1 - (1.0::DOUBLE / n + (x - mx) * (x - mx) / sxx)), 2) AS u FROM d CROSS JOIN g),
v AS (SELECT sqrt(sum(w * w * u)) AS sa, sqrt(sum(dx * dx * u)) / any_value(sxx) AS sb FROM e)
SELECT 'const' AS term, round(a, 3) AS coef, round(sa, 3) AS se, round(a / sa, 3) AS z, round(r2, 6) AS r_squared, n FROM g CROSS JOIN v
UNION ALL SELECT 'l_quantity', round(b, 3), round(sb, 3), round(b / sb, 3), round(r2, 6), n FROM g CROSS JOIN v""")
def ols_hc3(spark, sf):
    d = stats.ols_hc3(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return d.select("term", r6("coef", "coef", 3), r6("se", "se", 3), r6("z", "z", 3), r6("r_squared", "r_squared"), "n")


def _solved(columns: list[str]) -> str:
    """Sweep of the centred normal equations: the slopes of three regressors by determinants."""
    a, b, c = columns
    mean = ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(["y", *columns]))
    cov = ", ".join(f"covar_pop({x}, {z}) AS c{i}{j}" for i, x in enumerate(["y", *columns])
                    for j, z in enumerate(["y", *columns]) if i <= j)
    det = lambda m: (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - "
                     f"{m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")
    full = [[f"c{min(i, j)}{max(i, j)}" for j in (1, 2, 3)] for i in (1, 2, 3)]
    right = ["c01", "c02", "c03"]
    swapped = [[[right[i] if j == k else full[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    slopes = ", ".join(f"{det(m)} / {det(full)} AS b{k + 1}" for k, m in enumerate(swapped))
    minor = lambda r, q: [[full[i][j] for j in range(3) if j != q] for i in range(3) if i != r]
    inverse = ", ".join(f"{(-1) ** (i + j)} * ({minor(j, i)[0][0]} * {minor(j, i)[1][1]} - {minor(j, i)[0][1]} * "
                        f"{minor(j, i)[1][0]}) / {det(full)} / n AS i{i + 1}{j + 1}" for i in range(3) for j in range(3))
    d = ["(a - m1)", "(b - m2)", "(c - m3)"]
    lever = " + ".join(f"i{i + 1}{j + 1} * {d[i]} * {d[j]}" for i in range(3) for j in range(3))
    gain = {k: " + ".join(f"i{k}{j + 1} * {d[j]}" for j in range(3)) for k in (1, 2, 3)}
    return f"""WITH d AS (SELECT l_extendedprice AS y, {a} AS a, {b} AS b, {c} AS c FROM lineitem),
g AS (SELECT count(*) AS n, {mean.replace(a, 'a').replace(b, 'b').replace(c, 'c')},
  {cov.replace(a, 'a').replace(b, 'b').replace(c, 'c')} FROM d),
h AS (SELECT *, {slopes}, {inverse} FROM g),
e AS (SELECT h.*, a, b, c, power((y - m0 - b1 * (a - m1) - b2 * (b - m2) - b3 * (c - m3)) / (1 - 1.0::DOUBLE / n - ({lever})), 2) AS u
  FROM d CROSS JOIN h),
w AS (SELECT u, {gain[1]} AS w1, {gain[2]} AS w2, {gain[3]} AS w3, 1.0::DOUBLE / n - m1 * ({gain[1]}) - m2 * ({gain[2]}) - m3 * ({gain[3]}) AS w0 FROM e),
s AS (SELECT sqrt(sum(w0 * w0 * u)) AS s0, sqrt(sum(w1 * w1 * u)) AS s1, sqrt(sum(w2 * w2 * u)) AS s2, sqrt(sum(w3 * w3 * u)) AS s3 FROM w),
o AS (SELECT unnest(['const', '{a}', '{b}', '{c}']) AS term, unnest([m0 - b1 * m1 - b2 * m2 - b3 * m3, b1, b2, b3]) AS coef,
  unnest([s0, s1, s2, s3]) AS se, (b1 * c01 + b2 * c02 + b3 * c03) / c00 AS r2, n FROM h CROSS JOIN s)
SELECT term, round(coef, 2) AS coef, round(se, 2) AS se, round(r2, 6) AS r_squared, n FROM o"""


@query("ols_hc3_multiple", _solved(["l_quantity", "l_discount", "l_tax"]))
def ols_hc3_multiple(spark, sf):
    d = stats.ols_hc3(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return d.select("term", r6("coef", "coef", 2), r6("se", "se", 2), r6("r_squared", "r_squared"), "n")


@query("ols_hc3_shifted", """SELECT 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity), 3) AS coef,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r_squared FROM lineitem""")
def ols_hc3_shifted(spark, sf):
    """A regressor whose mean is 10^8: slope and fit are those without the shift."""
    d = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity") + 1e8)
    return stats.ols_hc3(d, "l_extendedprice", ["l_quantity"]).filter("term <> 'const'").select(
        "term", r6("coef", "coef", 3), r6("r_squared", "r_squared"))


@query("vif", """WITH g AS (SELECT count(*) AS n, corr(l_quantity, l_discount) AS r, sum(l_quantity) AS s1, sum(l_discount) AS s2,
  sum(l_quantity * l_quantity) AS s11, sum(l_quantity * l_discount) AS s12, sum(l_discount * l_discount) AS s22 FROM lineitem),
v AS (SELECT 1 / (1 - r * r) AS v, n / (n - (s22 * s1 * s1 - 2 * s12 * s1 * s2 + s11 * s2 * s2) / (s11 * s22 - s12 * s12)) AS c FROM g)
SELECT 'const' AS term, round(c, 6) AS vif FROM v UNION ALL SELECT 'l_quantity', round(v, 6) FROM v
UNION ALL SELECT 'l_discount', round(v, 6) FROM v""")
def vif(spark, sf):
    return stats.vif(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"]).select("term", r6("vif", "vif"))


@query("calibration_line", """WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
g AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy,
  regr_sxy(y, x) AS sxy, avg(x) AS mx, count(*) AS n, min(x) AS lo, max(x) AS hi FROM d),
p AS (SELECT CAST(i AS INTEGER) AS i, lo + (hi - lo) * i / 399 AS x, g.* FROM g CROSS JOIN (SELECT unnest(generate_series(0, 399)) AS i)),
q AS (SELECT i, x, a + b * x AS y, 1.96::DOUBLE * sqrt((syy - b * sxy) / (n - 2) * (1.0::DOUBLE / n + (x - mx) * (x - mx) / sxx)) AS h FROM p)
SELECT i, round(x, 6) AS x, round(y, 3) AS y, round(y - h, 3) AS ci_lower, round(y + h, 3) AS ci_upper FROM q""")
def calibration_line(spark, sf):
    d = stats.calibration_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", t=1.96)
    return d.select("i", r6("x", "x"), *[r6(c, c, 3) for c in ("y", "ci_lower", "ci_upper")])


# Fixed value: Student's t of 10 degrees of freedom at 0.975, from tables.
@query("calibration_line_small", """WITH d AS (SELECT c_nationkey AS x, avg(c_acctbal) AS y FROM customer GROUP BY c_nationkey ORDER BY x LIMIT 12),
g AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy,
  regr_sxy(y, x) AS sxy, avg(x) AS mx, count(*) AS n, min(x) AS lo, max(x) AS hi FROM d),
p AS (SELECT CAST(i AS INTEGER) AS i, lo + (hi - lo) * i / 10.0::DOUBLE AS x, g.* FROM g CROSS JOIN (SELECT unnest(generate_series(0, 10)) AS i)),
q AS (SELECT i, x, a + b * x AS y, 2.2281388519649385::DOUBLE * sqrt((syy - b * sxy) / (n - 2) * (1.0::DOUBLE / n + (x - mx) * (x - mx) / sxx)) AS h FROM p)
SELECT i, round(x, 6) AS x, round(y, 3) AS y, round(y - h, 3) AS ci_lower, round(y + h, 3) AS ci_upper FROM q""")
def calibration_line_small(spark, sf):
    """Few points, with the default t."""
    d = (table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("x")).agg(F.avg("c_acctbal").alias("y"))
         .orderBy("x").limit(12))
    line = stats.calibration_line(d, "x", "y", points=11)
    return line.select("i", r6("x", "x"), *[r6(c, c, 3) for c in ("y", "ci_lower", "ci_upper")])


def monthly(spark, sf):
    d = s.panel(spark, sf).select("loc", F.col("x").alias("y"), F.unix_date(
        F.make_date(F.col("year"), F.col("month"), F.lit(1))).alias("day"))
    return d


def lowess_sql(iterations: int) -> str:
    """Fit, then re-weight by the bisquare of the residuals and fit again."""
    parts = [f"""{s.panel_sql()}, d AS (SELECT loc, datediff('day', DATE '1970-01-01', make_date(year, month, 1)) AS day, x AS y FROM panel),
k AS (SELECT loc, floor(count(*) * 0.1::DOUBLE + 1e-10::DOUBLE) AS k FROM d GROUP BY loc),
r AS (SELECT a.loc, a.day, b.day AS bx, b.y AS yy, abs(a.day - b.day)::DOUBLE AS dist,
  row_number() OVER (PARTITION BY a.loc, a.day ORDER BY abs(a.day - b.day), b.day) AS rn, k.k
  FROM d a JOIN d b ON b.loc = a.loc JOIN k ON k.loc = a.loc),
n AS (SELECT *, max(dist) OVER (PARTITION BY loc, day) AS h FROM r WHERE rn <= k),
tri AS (SELECT *, CASE WHEN dist <= 0.001 * h THEN 1.0::DOUBLE WHEN dist > 0.999 * h THEN 0.0::DOUBLE
  ELSE power(1 - power(dist / h, 3), 3) END AS w0 FROM n),
q0 AS (SELECT loc, day, 1.0::DOUBLE AS q FROM d)"""]
    for i in range(iterations + 1):
        parts.append(f"""w{i} AS (SELECT t.loc, t.day, t.bx, t.yy, t.w0 * q.q AS w FROM tri t JOIN q{i} q ON q.loc = t.loc AND q.day = t.bx),
m{i} AS (SELECT loc, day, sum(w) AS sw, sum(w * bx) / nullif(sum(w), 0) AS mx, sum(w * yy) / nullif(sum(w), 0) AS my FROM w{i} GROUP BY ALL),
s{i} AS (SELECT w.loc, w.day, any_value(m.sw) AS sw, any_value(m.mx) AS mx, any_value(m.my) AS my, sum(w * (bx - mx) * (bx - mx)) AS sxx,
  sum(w * (bx - mx) * (yy - my)) AS sxy FROM w{i} w JOIN m{i} m ON m.loc = w.loc AND m.day = w.day GROUP BY ALL),
f{i} AS (SELECT s.loc, s.day, d.y, CASE WHEN sw > 0 THEN my + CASE WHEN sxx > 1e-6 THEN sxy / sxx ELSE 0 END * (s.day - mx) ELSE d.y END AS fit
  FROM s{i} s JOIN d ON d.loc = s.loc AND d.day = s.day),
u{i} AS (SELECT loc, day, abs(y - fit) / nullif(6 * median(abs(y - fit)) OVER (PARTITION BY loc), 0) AS u FROM f{i}),
q{i + 1} AS (SELECT loc, day, CASE WHEN u >= 0.999 THEN 0.0::DOUBLE WHEN u <= 0.001 THEN 1.0::DOUBLE
  ELSE coalesce(power(1 - u * u, 2), 1.0::DOUBLE) END AS q FROM u{i})""")
    return "WITH " + ",\n".join(parts) + f" SELECT loc, day, round(fit, 5) AS smooth FROM f{iterations}"


@query("lowess", lowess_sql(0))
def lowess(spark, sf):
    d = stats.lowess(monthly(spark, sf), "loc", "day", "y", iterations=0)
    return d.select("loc", "day", r6("smooth", "smooth", 5))


@query("lowess_robust", lowess_sql(3))
def lowess_robust(spark, sf):
    return stats.lowess(monthly(spark, sf), "loc", "day", "y", iterations=3).select("loc", "day", r6("smooth", "smooth", 5))
