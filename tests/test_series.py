"""Window features on hand-made series."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from arealis.functions import series as s
from arealis.operators import skew, temporal as t

SERIES = {
    "constant": [3] * 30,
    "zero": [0] * 30,
    "single": [5],
    "late": [0] * 29 + [1],
    "rising": list(range(1, 25)),
    "falling": list(range(30, 0, -1)),
    "mixed": [2, 0, 1, 5, 0, 0, 3, 4, 1, 0, 2, 2, 7, 0, 0, 1, 3, 2, 1, 0, 4, 4, 0, 1, 2, 6],
}


@pytest.fixture(scope="module")
def got(spark):
    rows = [(name, 2000 + i // 12, i % 12 + 1, v) for name, vs in SERIES.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "loc string, year int, month int, n long")
    out = {}
    for r in t.add_temporal_features(df, "loc", "n", risk=True).collect():
        out[(r["loc"], (r["year"] - 2000) * 12 + r["month"] - 1)] = r
    return out


def ewm(xs, span):
    a, out = 2 / (span + 1), []
    for x in xs:
        out.append(float(x) if not out else (1 - a) * out[-1] + a * x)
    return out


def wma(xs, n):
    out = []
    for i in range(len(xs)):
        part = xs[i - n + 1:i + 1] if i >= n - 1 else []
        if len(part) < n or any(v is None for v in part):
            out.append(None)
        else:
            out.append(max(0.0, sum((k + 1) * v for k, v in enumerate(part)) / (n * (n + 1) / 2)))
    return out


def hull(xs, n):
    half, full = wma(xs, n // 2), wma(xs, n)
    inner = [None if a is None or b is None else 2 * a - b for a, b in zip(half, full)]
    return wma(inner, math.isqrt(n))


def back(xs):
    return [None] + xs[:-1]


def same(a, b):
    return a is None and b is None or a is not None and b is not None and abs(a - b) < 1e-9


@pytest.mark.parametrize("name", SERIES)
def test_every_feature(got, name):
    xs = SERIES[name]
    e6, e12 = ewm(xs, 6), ewm(xs, 12)
    second = ewm(e6, 6)
    third = ewm(second, 6)
    tema = [max(0.0, 3 * a - 3 * b + c) for a, b, c in zip(e6, second, third)]
    expected = {"n_ewm_6": back(e6), "n_ewm_12": back(e12), "n_tema_6": back(tema),
                "n_hma_4": back(hull(xs, 4)), "n_hma_5": back(hull(xs, 5))}

    def past(i, k):
        return xs[i - k] if i >= k else None

    def span(i, a, b):
        return xs[i - a:i - b + 1] if i >= a else None

    for i in range(len(xs)):
        row = got[(name, i)]
        for column, values in expected.items():
            assert same(row[column], values[i]), (column, i)
        for k in (1, 3, 6, 12):
            assert row[f"n_lag_{k}"] == past(i, k)
        year = span(i, 12, 1)
        assert row["n_sum_12"] == (sum(year) if year else None)
        quarter = span(i, 3, 1)
        assert row["n_active_3"] == (None if i == 0 else int(bool(quarter) and sum(quarter) > 0))
        near, far = past(i, 3), past(i, 6)
        assert same(row["n_pct_change"], (near - far) / far if far else None)
        half = span(i, 8, 3)
        mean = sum(half) / 6 if half else None
        assert same(row["n_volatility_6m"], statistics.stdev(half) / mean if mean else None)
        a, b = span(i, 5, 3), span(i, 11, 9)
        assert same(row["n_trend_ratio"], (sum(a) / 3) / (sum(b) / 3) if b and sum(b) else None)
        risk = 0.134 * sum((past(i, k) or 0) * max(0, 0.106 * k ** -0.383 - 0.018) for k in range(1, 25))
        assert same(row["revictimization_risk"], risk)


def test_first_rows_of_hull_means(got):
    assert got[("rising", 4)]["n_hma_4"] is None and got[("rising", 5)]["n_hma_4"] is not None
    assert got[("rising", 5)]["n_hma_5"] is None and got[("rising", 6)]["n_hma_5"] is not None


def test_falling_series_changes_are_negative(got):
    assert got[("falling", 10)]["n_pct_change"] < 0


@pytest.mark.parametrize("span", [6, 40])
def test_series_of_any_length(spark, span):
    n = 7000
    df = spark.range(n).select(F.lit("a").alias("loc"), F.col("id").cast("int").alias("i"),
                               (F.col("id") * 7 % 11).cast("long").alias("n"))
    exact = ewm([i * 7 % 11 for i in range(n)], span)
    rows = t.add_ewm(df, "loc", "n", ["i"], (span,)).orderBy("i").collect()
    assert rows[0][f"n_ewm_{span}"] is None
    assert all(abs(rows[i][f"n_ewm_{span}"] - exact[i - 1]) < 1e-9 for i in range(1, n))


def test_spans_that_need_separate_passes():
    with pytest.raises(ValueError, match="too far apart"):
        s.ewm_block((2, 400))


def test_period_and_weights():
    with pytest.raises(ValueError):
        s.wma(F.col("x"), 0, s.series_window("loc", "t"))
    assert s.repeat_weight(0) == 0.0
    assert s.repeat_weight(1) == pytest.approx(0.088)


@pytest.mark.parametrize("span", [6])
def test_long_series_are_spread_over_tasks(spark, span, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 700)
    n = 7000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, "a").alias("loc"), F.col("id").cast("int").alias("i"),
                               (F.col("id") * 7 % 11).cast("long").alias("n"))
    got = t.add_ewm(df, "loc", "n", ["i"], (span,), long=True).withColumn("part", F.spark_partition_id())
    assert got.groupBy("part").count().agg(F.max("count")).first()[0] < n / 2
    rows = {r["i"]: r[f"n_ewm_{span}"] for r in got.collect()}
    for first in (0, 1):
        own = range(first, n, 2)
        exact = ewm([i * 7 % 11 for i in own], span)
        assert rows[first] is None
        assert all(abs(rows[i] - exact[k - 1]) < 1e-9 for k, i in enumerate(own) if k)
