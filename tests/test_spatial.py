import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.operators import skew, spatial as sp
from arealis.operators.skew import exact_quantiles, numbered_rows
from arealis.session import cut_lineage, tables_written


def brute(points, k):
    out = {}
    for a, x, y in points:
        near = sorted((math.hypot(x - u, y - v), b) for b, u, v in points if b != a)[:k]
        out[a] = [b for _, b in near]
    return out


def edges_of(df):
    out = {}
    for r in df.orderBy("location", "neighbor_rank").collect():
        out.setdefault(r["location"], []).append(r["neighbor"])
    return out


def crowded():
    """A third of the points on one spot, a tiny dense cluster, scatter and an outlier."""
    rng = random.Random(3)
    points = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(150)]
    points += [(1000 + i, 5.0, 5.0) for i in range(120)]
    points += [(2000 + i, 3 + rng.random() * 1e-6, 3 + rng.random() * 1e-6) for i in range(100)]
    return points + [(5000, 1e6, 1e6)]


@pytest.mark.parametrize("small", [0, 5000])
def test_neighbours_equal_brute_force(spark, small):
    points = crowded()
    df = spark.createDataFrame(points, "id long, x double, y double")
    assert edges_of(sp.knn_edges(df, "id", "x", "y", 5, small=small)) == brute(points, 5)


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 0.0)], "id long, x double, y double")
    for small in (0, 100):
        assert edges_of(sp.knn_edges(df, "id", "x", "y", 5, small=small)) == {1: [2, 3], 2: [1, 3], 3: [1, 2]}


def test_station_search_forms_agree(spark):
    rng = random.Random(5)
    points = spark.createDataFrame([(i, rng.uniform(51, 52), rng.uniform(-1, 1)) for i in range(200)]
                                   + [(900, None, 0.1)], "id long, lat double, lon double")
    posts = spark.createDataFrame([(i, rng.uniform(51, 52), rng.uniform(-1, 1)) for i in range(60)],
                                  "s long, slat double, slon double")
    rows = [{r["id"]: r for r in sp.nearest_station(points, "lat", "lon", posts, "s", "slat", "slon",
                                                    small=n).collect()} for n in (1000, 0)]
    assert rows[0].keys() == rows[1].keys() and rows[0][900]["nearest_station"] is None
    for key, a in rows[0].items():
        b = rows[1][key]
        assert a["nearest_station"] == b["nearest_station"]
        assert key == 900 or a["distance_m"] == pytest.approx(b["distance_m"])


def test_neighbour_features(spark):
    panel = spark.createDataFrame([("a", 2020, 1, 4), ("b", 2020, 1, 2), ("c", 2020, 1, 6), ("d", 2020, 1, 1)],
                                  "loc string, year int, month int, n long")
    edges = spark.createDataFrame([("a", "b", 100.0, 1), ("a", "c", 300.0, 2), ("a", "zz", 0.0, 3),
                                   ("b", "zz", 1.0, 1)],
                                  "location string, neighbor string, distance double, neighbor_rank int")
    got = {r["loc"]: r for r in sp.add_neighbor_features(panel, edges, "loc", "n").collect()}
    a = got["a"]
    assert (a["neighbor_avg"], a["neighbor_max"], a["closest_neighbor"]) == (4.0, 6, 2)
    assert a["neighbor_weighted_avg"] == pytest.approx((2 / 200 + 6 / 400) / (1 / 200 + 1 / 400 + 1 / 100))
    assert got["b"]["neighbor_avg"] is None and got["b"]["neighbor_weighted_avg"] == 0.0
    assert got["d"]["neighbor_weighted_avg"] is None      # no neighbours at all
    present = {r["loc"]: r for r in sp.add_neighbor_features(panel, edges, "loc", "n", only_present=True).collect()}
    assert present["a"]["neighbor_weighted_avg"] == pytest.approx((2 / 200 + 6 / 400) / (1 / 200 + 1 / 400))


def test_numbering_of_a_hot_group(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("g"))
    rows = numbered_rows(df, ["g"], "id", "pos", "size").collect()
    for g, size in (("hot", 2500), ("cold", 500)):
        part = sorted((r["id"], r["pos"], r["size"]) for r in rows if r["g"] == g)
        assert [p for _, p, _ in part] == list(range(1, size + 1)) and {s for _, _, s in part} == {size}


@pytest.mark.parametrize("accuracy, bracket, grid", [(20_000, 1 << 16, 512), (50, 16, 8)])
def test_exact_quantiles(spark, monkeypatch, accuracy, bracket, grid):
    for name, value in (("ACCURACY", accuracy), ("BRACKET", bracket), ("GRID", grid)):
        monkeypatch.setattr(skew, name, value)
    rng = random.Random(1)
    values = [rng.gauss(0, 1) for _ in range(500)] + [7.0] * 400 + [1e12, -3e9] + [None] * 5
    df = spark.createDataFrame([(v, None) for v in values], "v double, w double")
    got = exact_quantiles(df, ["v", "w"], (0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0))
    assert got["w"] == [None] * 7
    kept = [v for v in values if v is not None]
    assert got["v"] == pytest.approx(list(np.quantile(kept, (0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0))))


def test_quantiles_need_two_reads(spark):
    """However many columns and quantiles, and with one value in a third of the rows."""
    df = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7.5D, id * 0.001D) AS a", "-id AS b", "id % 11 AS c", "cast(NULL AS double) AS d")
    context = spark.sparkContext
    context.setJobGroup("quantiles", "")
    got = exact_quantiles(df, list("abcd"), (0.05, 0.25, 0.5, 0.75, 0.95))
    jobs = len(context.statusTracker().getJobIdsForGroup("quantiles"))
    context.setLocalProperty("spark.jobGroup.id", None)
    pdf = df.toPandas()
    for c in "abc":
        assert got[c] == pytest.approx(list(np.quantile(pdf[c], (0.05, 0.25, 0.5, 0.75, 0.95))))
    assert got["d"] == [None] * 5 and jobs <= 4  # a read is a shuffle stage and a result under adaptive execution


def test_search_rounds_and_candidates_do_not_grow_with_the_layout(spark):
    """Points whose distances halve need no more tables than scattered ones, and few leaves a query."""
    rng = random.Random(8)
    layouts = {"halving": [(i, 0.5 ** i, 0.0) for i in range(60)],
               "scattered": [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(1500)],
               "crossed": [(i, float(i), 0.0) for i in range(300)] + [(300 + i, 0.0, i + 1.0) for i in range(300)]}
    for name, points in layouts.items():
        df = spark.createDataFrame(points, "id long, x double, y double")
        before = tables_written()
        assert edges_of(sp.knn_edges(df, "id", "x", "y", 5, small=0)) == brute(points, 5), name
        assert tables_written() - before <= 5
        sites = cut_lineage(df.select(F.col("x").alias("_t0"), F.col("y").alias("_t1"), F.array("id").alias("_keys")))
        levels, leaves = sp.split_tree(sites, ["_t0", "_t1"])
        sizes = [r.n for r in leaves.select(F.size("_sites").alias("n")).collect()]
        # In a cross each level loses half of its cuts to ties.
        assert sum(sizes) == len(points) and max(sizes) <= 4 * sp.LEAF
        spots = df.selectExpr("x AS _q0", "y AS _q1")
        assert sp._near_leaves(spots, ["_q0", "_q1"], levels, leaves, ["_t0", "_t1"], 6).count() <= 8 * len(points)


def test_exact_quantiles_with_infinities(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (nan, inf, -inf, 3.0, 1.0, None, 2.0)], "v double")
    got = exact_quantiles(df, ["v"], (0.0, 0.1, 0.2, 0.4, 0.5, 0.8, 1.0))["v"]
    assert got[:2] == [-inf, -inf] and got[2:6] == [1.0, 2.0, 2.5, inf] and got[6] != got[6]
    only = spark.createDataFrame([(inf,), (inf,)], "v double")
    assert exact_quantiles(only, ["v"], (0.3,))["v"] == [inf]


def test_stations_of_one_name_and_unusable_points(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, 51.0, 0.0), (2, nan, 0.0), (3, None, 0.0), (4, 52.0, float("inf")),
                                    (5, 51.5, 0.5), (5, 51.5, 0.5)], "id long, lat double, lon double")
    posts = spark.createDataFrame([("x", 51.0, 0.1), ("x", 53.0, 0.0), ("b", 51.5, 0.5), ("a", 51.5, 0.5),
                                   ("c", nan, 0.0)], "s string, slat double, slon double")
    for small in (1000, 0):
        got = sp.nearest_station(points, "lat", "lon", posts, "s", "slat", "slon", small=small).collect()
        found = sorted((r.id, r.nearest_station, r.distance_m and round(r.distance_m)) for r in got)
        assert found == [(1, "x", 6998), (2, None, None), (3, None, None), (4, None, None), (5, "a", 0), (5, "a", 0)]


def test_colocated_and_histogram(spark):
    df = spark.createDataFrame([(1, 1.00000001, 2.0), (2, 1.0, 2.0), (3, 1.1, 2.0)], "id long, lat double, lon double")
    got = {r["id"]: (r["ordinal"], r["place_size"]) for r in sp.colocated_points(df, "lat", "lon", "id").collect()}
    assert got == {1: (1, 2), 2: (2, 2), 3: (1, 1)}
    bins = {r["bin"]: r["n"] for r in sp.distance_histogram(df, "lat", 4).collect()}
    assert bins == {0: 2, 3: 1}


def test_quantiles_of_any_scale_without_sketches(spark, monkeypatch):
    monkeypatch.setattr(skew, "BRACKET", 16)
    monkeypatch.setattr(F, "percentile_approx", None)
    rng = random.Random(3)
    values = [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300) for _ in range(800)] + [0.0] * 100 + [1.7e308, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = (0.01, 0.2, 0.5, 0.7, 0.95)
    got = exact_quantiles(df, ["v"], probs)["v"]
    ordered = sorted(values)
    for q, v in zip(probs, got):
        at = q * (len(values) - 1)
        assert ordered[int(at)] <= v <= ordered[int(at) + 1]


def test_rows_without_neighbours_take_no_part_in_the_join(spark):
    panel = spark.range(60).select((F.col("id") % 20).alias("loc"), F.lit(2020).alias("year"),
                                   (F.floor(F.col("id") / 20) + 1).cast("int").alias("month"), F.col("id").alias("n"))
    edges = spark.createDataFrame([(1, 2, 0.5, 1), (1, 99, 0.7, 2)], "location long, neighbor long, distance double, neighbor_rank int")
    got = sp.neighbor_self_join(panel, edges, "loc", "n")
    assert "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((r.loc, r.month, r.neighbor or 0, r.n_neighbor) for r in got.collect())
    assert len(rows) == 63
    assert [r for r in rows if r[0] == 1] == [(1, m, k, 20 * (m - 1) + 2 if k == 2 else None) for m in (1, 2, 3) for k in (2, 99)]


def test_panel_of_neighbours_is_not_sent_to_the_driver(spark, monkeypatch):
    panel = spark.range(900).select((F.col("id") % 300).alias("loc"), F.lit(2020).alias("year"),
                                    (F.floor(F.col("id") / 300) + 1).cast("int").alias("month"), F.lit(7).alias("n"))
    edges = spark.range(1, 200).selectExpr("id AS location", "id + 150 AS neighbor", "0.5D AS distance", "1 AS neighbor_rank")

    def joins(df):
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")

    few = sp.neighbor_self_join(panel, edges, "loc", "n")
    assert joins(few) == (2, 1)  # both joins with the edges, which are few, are sent out
    monkeypatch.setattr(sp, "TASK_ROWS", 100)
    many = sp.neighbor_self_join(panel, edges, "loc", "n")
    assert joins(many) == (0, 3)
    rows = sorted(map(tuple, few.select("loc", "month", "neighbor", "n_neighbor").fillna(-1).collect()))
    assert rows == sorted(map(tuple, many.select("loc", "month", "neighbor", "n_neighbor").fillna(-1).collect()))
    assert len(rows) == 900 and sum(r[3] == 7 for r in rows) == 149 * 3
