"""Regression statistics as sums over the data, and local smoothing.

Linear models need the data only through sums of products: the tables are reduced
to a few numbers per model in one or two aggregates, and a k-by-k system is solved
from them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.local_lines import local_lines
from ..session import cut_lineage
from ..ship import map_arrow
from .skew import numbered_rows, task_count


def pearson(df: DataFrame, x: str, y: str, out: str = "corr") -> DataFrame:
    return df.agg(F.corr(x, y).alias(out))


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()


def _products(df: DataFrame, columns: Sequence[Column], weight: Column | None = None) -> np.ndarray:
    """Matrix of sums of pairwise products, one aggregate."""
    k = len(columns)
    w = F.lit(1.0) if weight is None else weight
    row = df.agg(*[F.sum(columns[i] * columns[j] * w).alias(f"s{i}_{j}")
                   for i in range(k) for j in range(i, k)]).first()
    m = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = row[f"s{i}_{j}"] or 0.0
    return m


def _means(data: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray]:
    row = data.agg(F.count("*"), *[F.avg(c) for c in columns]).first()
    return row[0], np.array([0.0 if v is None else v for v in row[1:]])


def _centred_inverse(m: np.ndarray, names: Sequence[str], means: np.ndarray, n: int) -> np.ndarray:
    """Inverse of centred sums of products; columns that depend on the others are named in the error."""
    spread = np.sqrt(np.diag(m))
    flat = [c for c, s, mean in zip(names, spread, means) if s <= 1e-13 * np.sqrt(n) * max(abs(mean), 1e-300)]
    if flat:
        raise ValueError(f"constant columns: {', '.join(flat)}")
    corr = m / np.outer(spread, spread)
    values, vectors = np.linalg.eigh(corr)
    if values[0] < 1e-12:
        part = [c for c, v in zip(names, np.abs(vectors[:, 0])) if v > 1e-3]
        raise ValueError(f"columns that depend on each other: {', '.join(part)}")
    return np.linalg.inv(corr) / np.outer(spread, spread)


def ols_hc3(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Least squares with constant and HC3 standard errors.

    Rows: term, coef, se, z, p_value, r_squared, n. One aggregate gives the means, one
    the centred normal equations and one the sandwich's middle, where leverage and
    residual are plain column arithmetic. Centring keeps the digits of columns whose
    mean is large against their deviation.
    """
    data = _complete(df, [y, *xs])
    n, means = _means(data, [y, *xs])
    centred = [F.col(c) - F.lit(float(m)) for c, m in zip([y, *xs], means)]
    m = _products(data, centred)
    inv = _centred_inverse(m[1:, 1:], xs, means[1:], n)
    slopes = inv @ m[1:, 0]
    residual, leverage = centred[0], F.lit(1.0 / n)
    for b, x in zip(slopes, centred[1:]):
        residual = residual - F.lit(float(b)) * x
    for i, u in enumerate(centred[1:]):
        for j, v in enumerate(centred[1:]):
            leverage = leverage + F.lit(float(inv[i, j])) * u * v
    middle = _products(data, [F.lit(1.0), *centred[1:]], F.pow(residual / (1 - leverage), 2))
    # Back from the centred columns: the constant is the mean of y less the slopes' parts.
    k = len(xs) + 1
    bread = np.zeros((k, k))
    bread[0, 0], bread[1:, 1:] = 1.0 / n, inv
    back = np.eye(k)
    back[0, 1:] = -means[1:]
    se = np.sqrt(np.diag(back @ bread @ middle @ bread @ back.T))
    beta = back @ np.concatenate([[means[0]], slopes])
    r2 = slopes @ m[1:, 0] / m[0, 0]
    rows = []
    for name, b, e in zip(["const", *xs], beta, se):
        z = b / e
        rows.append((name, float(b), float(e), float(z), math.erfc(abs(z) / math.sqrt(2)),
                     float(r2), int(n)))
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, se double, z double, p_value double, r_squared double, n bigint")


def vif(df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Variance inflation of each regressor and of the constant, from centred sums.

    Regressors use the centred R-squared of their auxiliary regression; the
    constant, whose auxiliary regression has no constant, the uncentred one.
    """
    data = _complete(df, xs)
    n, means = _means(data, xs)
    m = _products(data, [F.col(c) - F.lit(float(v)) for c, v in zip(xs, means)])
    inv = _centred_inverse(m, xs, means, n)
    rows = [("const", float(1 + n * means @ inv @ means))]
    rows += [(name, float(inv[j, j] * m[j, j])) for j, name in enumerate(xs)]
    return df.sparkSession.createDataFrame(rows, "term string, vif double")


def _t_upper(t: float, dof: float) -> float:
    """P(T > t) for t >= 0: half the incomplete beta function, by its continued fraction."""
    x, a, b = dof / (dof + t * t), dof / 2, 0.5
    if x >= 1:
        return 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 0.5 * (1 - front * _beta_fraction(b, a, 1 - x) / b)
    return 0.5 * front * _beta_fraction(a, b, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    value = d
    for m in range(1, 500):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + term * d or tiny)
            c = 1 + term / c or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return value


def t_quantile(p: float, dof: float) -> float:
    """Student-t quantile, by bisection of the distribution function."""
    if p < 0.5:
        return -t_quantile(1 - p, dof)
    if dof > 1e7:  # equal to the normal quantile in all digits used
        return NormalDist().inv_cdf(p)
    low, high = 0.0, 1.0
    while _t_upper(high, dof) > 1 - p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _t_upper(middle, dof) > 1 - p else (low, middle)
    return (low + high) / 2


def calibration_line(df: DataFrame, actual: str, fitted: str, points: int = 400,
                     t: float | None = None) -> DataFrame:
    """Fitted regressed on actual: grid, predicted mean and 95 % interval of the mean."""
    data = _complete(df, [actual, fitted])
    if t is None:
        t = t_quantile(0.975, data.count() - 2)
    s = data.agg(
        F.regr_slope(fitted, actual).alias("b"), F.regr_intercept(fitted, actual).alias("a"),
        F.regr_sxx(fitted, actual).alias("sxx"), F.regr_syy(fitted, actual).alias("syy"),
        F.regr_sxy(fitted, actual).alias("sxy"), F.avg(actual).alias("mx"),
        F.count("*").alias("n"), F.min(actual).alias("lo"), F.max(actual).alias("hi"))
    grid = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1)
    variance = (F.col("syy") - F.col("b") * F.col("sxy")) / (F.col("n") - 2)
    half = F.lit(float(t)) * F.sqrt(variance * (1 / F.col("n") + F.pow(F.col("x") - F.col("mx"), 2)
                                                / F.col("sxx")))
    return (grid.withColumn("x", x).withColumn("y", F.col("a") + F.col("b") * F.col("x"))
            .select("i", "x", "y", (F.col("y") - half).alias("ci_lower"),
                    (F.col("y") + half).alias("ci_upper")))


#: Rows of one task of a long series, without those it looks at on both sides.
LOWESS_ROWS = 1 << 14


def lowess(df: DataFrame, series: str, x: str, y: str, frac: float = 0.10, iterations: int = 3,
           out: str = "smooth", chunk: int = LOWESS_ROWS) -> DataFrame:
    """Locally weighted line per series, with robust re-weighting.

    The k nearest points of a row (k: ``frac`` of its series) lie within k rows of it in x
    order. A series is numbered without gathering it in one task and dealt out in chunks
    of at least ``chunk`` rows and 2k rows, each with the k rows on both sides; within a chunk
    the cost of a row does not depend on k (see ``local_lines``). Distances that tie are
    resolved towards smaller x; series too short for one neighbour keep their values. Rows
    without a finite x or y take no part and get NULL.
    """
    base = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(series).alias("_series"),
                     F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    real = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf")) for c in ("_x", "_y")]
    fit = F.coalesce(real[0] & real[1], F.lit(False))
    rows = cut_lineage(numbered_rows(cut_lineage(base.withColumn("_fit", fit)), ["_series", "_fit"], "_x", "_pos", "_n"))
    known = rows.filter("_fit")
    # Numbers pack tightly on their way: the tasks are as many as the rows need, and not merged.
    tasks = task_count(df.sparkSession, rows.count())
    k = F.floor(F.col("_n") * float(frac) + 1e-10).cast("bigint")
    wide = F.greatest(F.lit(chunk).cast("bigint"), 2 * F.col("_k"))
    state = known.select("_series", "_pos", "_n", "_x", "_y", F.lit(1.0).alias("_r")).withColumn("_k", k)
    for step in range(iterations + 1):
        at = F.col("_pos") - 1
        dealt = state.withColumn("_wide", wide).select("*", F.explode(F.sequence(
            F.floor(F.greatest(at - F.col("_k"), F.lit(0)) / F.col("_wide")),
            F.floor(F.least(at + F.col("_k"), F.col("_n") - 1) / F.col("_wide")))).alias("_chunk"))
        placed = dealt.repartition(tasks, "_series", "_chunk").sortWithinPartitions("_series", "_chunk", "_pos")
        fitted = map_arrow(placed.select("_series", "_chunk", "_pos", "_x", "_y", "_r", "_k", "_wide"), _fit_chunks(), T.StructType([
            rows.schema["_series"], T.StructField("_pos", T.LongType()), T.StructField("_smooth", T.DoubleType())]))
        fitted = cut_lineage(fitted.withColumnsRenamed({"_series": "_s", "_pos": "_p"}))
        own = F.col("_series").eqNullSafe(F.col("_s")) & (F.col("_pos") == F.col("_p"))
        if step == iterations:
            return rows.repartition(tasks, "_series", "_pos").join(fitted, own & F.col("_fit"), "left").select("_row.*", F.col("_smooth").alias(out))
        state = cut_lineage(state.repartition(tasks, "_series", "_pos").join(fitted, own).withColumn("_gap", F.abs(F.col("_y") - F.col("_smooth"))))
        scales = state.groupBy(F.col("_series").alias("_s2")).agg((6 * F.percentile("_gap", F.lit(0.5))).alias("_scale"))
        u = F.try_divide(F.col("_gap"), F.col("_scale"))
        robust = F.when(u >= 0.999, 0.0).when(u <= 0.001, 1.0).otherwise(F.coalesce(F.pow(1 - u * u, 2), F.lit(1.0)))
        state = cut_lineage(state.join(scales, F.col("_series").eqNullSafe(F.col("_s2"))).select(
            "_series", "_pos", "_n", "_x", "_y", robust.alias("_r"), "_k"))


def _fit_chunks():
    """For rows (series, chunk, pos, x, y, weight, k, rows of a chunk) sorted so: the fit of each row of its own chunk."""
    def fit(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        chunk, pos, x, y, r, k, wide = (table.column(i).to_numpy() for i in range(1, 8))
        own = np.flatnonzero((pos - 1) // wide[0] == chunk[0])
        return pa.RecordBatch.from_arrays(
            [table.column(0).combine_chunks().take(pa.array(own)), pa.array(pos[own]),
             pa.array(local_lines(x, y, r, own, int(k[0])), pa.float64())], names=["_series", "_pos", "_smooth"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            code = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            chunk = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(chunk) != 0)) + 1).tolist(), n]
            if held and (held[-1].column(0)[held[-1].num_rows - 1] != batch.column(0)[0]
                         or held[-1].column(1)[0].as_py() != chunk[0]):
                yield fit(held)
                held = []
            for a, b in zip(cuts, cuts[1:]):
                held.append(batch.slice(a, b - a))
                if b < n:
                    yield fit(held)
                    held = []
        if held:
            yield fit(held)
    return run
