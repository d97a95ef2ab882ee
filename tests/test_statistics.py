import math
import random

import numpy as np
import pytest

from arealis.functions import local_lines
from arealis.operators import stats


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(300):
        a, b = rng.gauss(2, 1), rng.gauss(0, 2)
        rows.append((a, b + 0.5 * a, 1 + 2 * a - b + rng.gauss(0, 1 + abs(a))))
    return np.array(rows), spark.createDataFrame(rows, "a double, b double, y double")


def test_hc3_against_dense_algebra(data):
    m, df = data
    x, y = np.column_stack([np.ones(len(m)), m[:, :2]]), m[:, 2]
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ y
    e = y - x @ beta
    h = np.einsum("ij,jk,ik->i", x, inv, x)
    cov = inv @ (x.T * (e / (1 - h)) ** 2) @ x @ inv
    got = {r["term"]: r for r in stats.ols_hc3(df, "y", ["a", "b"]).collect()}
    for i, term in enumerate(["const", "a", "b"]):
        assert got[term]["coef"] == pytest.approx(beta[i])
        assert got[term]["se"] == pytest.approx(math.sqrt(cov[i, i]))
    assert got["a"]["r_squared"] == pytest.approx(1 - e @ e / ((y - y.mean()) @ (y - y.mean())))


def test_vif(data):
    m, df = data
    x = np.column_stack([np.ones(len(m)), m[:, :2]])
    got = {r["term"]: r["vif"] for r in stats.vif(df, ["a", "b"]).collect()}
    for j, term in enumerate(["const", "a", "b"]):
        rest = np.delete(x, j, axis=1)
        left = x[:, j] - rest @ np.linalg.lstsq(rest, x[:, j], rcond=None)[0]
        total = x[:, j] @ x[:, j] if j == 0 else ((x[:, j] - x[:, j].mean()) ** 2).sum()
        assert got[term] == pytest.approx(total / (left @ left))


def test_t_quantile():
    assert stats.t_quantile(0.975, 30) == pytest.approx(2.042272, abs=1e-5)
    assert stats.t_quantile(0.975, 1) == pytest.approx(12.706205, abs=1e-5)
    assert stats.t_quantile(0.975, 2) == pytest.approx(4.302653, abs=1e-5)
    assert stats.t_quantile(0.9, 5) == pytest.approx(1.475884, abs=1e-5)
    assert stats.t_quantile(0.025, 10) == pytest.approx(-2.228139, abs=1e-5)
    assert stats.t_quantile(0.975, 1e9) == pytest.approx(1.959964, abs=1e-6)


def plain_lowess(x, y, frac, iterations):
    n = len(x)
    k = int(frac * n + 1e-10)
    robust, fit = [1.0] * n, [0.0] * n
    for step in range(iterations + 1):
        for i in range(n):
            near = sorted(range(n), key=lambda j: (abs(x[j] - x[i]), x[j]))[:k]
            radius = max(abs(x[j] - x[i]) for j in near)
            w = []
            for j in near:
                u = abs(x[j] - x[i]) / radius
                w.append(robust[j] * (1.0 if u <= 0.001 else 0.0 if u > 0.999 else (1 - u ** 3) ** 3))
            sw = sum(w)
            if sw <= 0:
                fit[i] = y[i]
                continue
            mx = sum(a * x[j] for a, j in zip(w, near)) / sw
            my = sum(a * y[j] for a, j in zip(w, near)) / sw
            sxx = sum(a * (x[j] - mx) ** 2 for a, j in zip(w, near))
            sxy = sum(a * (x[j] - mx) * (y[j] - my) for a, j in zip(w, near))
            fit[i] = my + (sxy / sxx if sxx > 1e-9 else 0.0) * (x[i] - mx)
        gaps = [abs(a - b) for a, b in zip(y, fit)]
        scale = 6 * float(np.median(gaps))
        robust = [0.0 if g / scale >= 0.999 else 1.0 if g / scale <= 0.001 else (1 - (g / scale) ** 2) ** 2
                  for g in gaps]
    return fit


@pytest.mark.parametrize("iterations", [0, 3])
def test_lowess(spark, iterations):
    rng = random.Random(2)
    rows, expected = [], {}
    for name, n in (("a", 60), ("b", 31)):
        x = [float(i * 30 + rng.randint(0, 3)) for i in range(n)]
        y = [math.sin(v / 200) + rng.gauss(0, 0.2) + (3 if i % 17 == 5 else 0) for i, v in enumerate(x)]
        rows += [(name, a, b) for a, b in zip(x, y)]
        expected.update({(name, a): f for a, f in zip(x, plain_lowess(x, y, 0.2, iterations))})
    df = spark.createDataFrame(rows, "s string, x double, y double")
    for r in stats.lowess(df, "s", "x", "y", 0.2, iterations).collect():
        assert r["smooth"] == pytest.approx(expected[(r["s"], r["x"])], abs=1e-7)


def test_local_lines_of_wide_windows_like_plain_sums():
    """Windows that are summed by moments: even, crowded and heavy-tailed places, zero weights, ties."""
    rng = np.random.default_rng(0)
    n = 400
    places = {"even": np.arange(float(n)) * 30 + 7e5, "tailed": np.sort(np.exp(rng.normal(0, 3, n))),
              "crowded": np.sort(np.concatenate([rng.normal(c, 10.0 ** -c, n // 4) for c in range(4)])),
              "tied": np.sort(rng.integers(0, 40, n)).astype(float)}
    for name, x in places.items():
        y = np.sin(x / (x.max() - x.min()) * 20) * 100 + rng.normal(0, 1, n)
        r = np.where(rng.random(n) < 0.1, 0, rng.random(n))
        for k in (10, 65, 130, n):
            got = local_lines.local_lines(x, y, r, np.arange(n), k)
            start = local_lines.nearest_rows(x, np.arange(n), k)
            for i in range(0, n, 7):
                near = np.arange(start[i], start[i] + k)
                far = np.sort(np.abs(x - x[i]))[k - 1]
                assert np.abs(x[near] - x[i]).max() == far
                u = np.abs(x[near] - x[i]) / far if far else np.zeros(k)
                w = r[near] * np.where(u <= 0.001, 1, np.where(u > 0.999, 0, (1 - u ** 3) ** 3))
                if not w.sum() > 0:
                    assert got[i] == y[i]
                    continue
                v = x[near] - x[i]
                mx, my = (w * v).sum() / w.sum(), (w * y[near]).sum() / w.sum()
                sxx, sxy = (w * (v - mx) ** 2).sum(), (w * (v - mx) * (y[near] - my)).sum()
                want = my - (sxy / sxx * mx if sxx > 1e-12 * max((w * v * v).sum(), 1e-300) else 0)
                assert got[i] == pytest.approx(want, abs=2e-6), (name, k, i)


def test_a_long_series_in_chunks_and_rows_without_values(spark):
    n = 700
    x = np.arange(n) * 1.0
    y = np.sin(x / 50) + (x % 13 == 3)
    rows = [("a", float(a), float(b), i) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(None, float(a), float(b), 1) for a, b in zip(x[:40], y)]
    rows += [("a", None, 1.0, -1), ("a", 5.0, None, -2), ("b", float("nan"), 1.0, -3), ("short", 1.0, 7.0, -4)]
    df = spark.createDataFrame(rows, "s string, x double, y double, _pos int").repartition(5)
    got = {(r.s, r._pos, r.x if r._pos == 1 else None): r.smooth for r in stats.lowess(df, "s", "x", "y", 0.2, 1, chunk=64).collect()}
    assert len(got) == len(rows) and [got["a", -1, None], got["a", -2, None], got["b", -3, None]] == [None] * 3
    assert got["short", -4, None] == 7.0
    want = plain_lowess(x.tolist(), y.tolist(), 0.2, 1)
    assert [got["a", i, 1.0 if i == 1 else None] for i in range(n)] == pytest.approx(want, abs=1e-6)
    assert [got[None, 1, a] for a in x[:40]] == pytest.approx(plain_lowess(x[:40].tolist(), y[:40].tolist(), 0.2, 1), abs=1e-7)


def test_dependent_columns_are_named(spark):
    df = spark.range(50).selectExpr("id * 1.0 AS a", "id * 2.0 AS b", "id % 7 * 1.0 AS c", "1.0 AS k", "id % 3 * 1.0 AS y")
    with pytest.raises(ValueError, match="a, b"):
        stats.ols_hc3(df, "y", ["a", "b", "c"])
    with pytest.raises(ValueError, match="constant columns: k"):
        stats.vif(df, ["a", "k"])
