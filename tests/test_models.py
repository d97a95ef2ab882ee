import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from arealis.operators import boosting, model as m


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        F.concat(F.lit("L"), F.col("id") % 12).alias("loc"), (2000 + F.floor(F.col("id") / 144)).cast("int").alias("year"),
        (F.floor(F.col("id") / 12) % 12 + 1).cast("int").alias("month"), (F.col("id") / 600).alias("time_index_norm"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 5).cast("double").alias("f"), (F.col("id") % 5 + F.col("id") % 2).alias("n"))
    return df.cache()


def test_splits_are_whole_and_disjoint(table):
    d = m.temporal_split(table)
    top = table.agg(F.max("time_index_norm")).first()[0]
    assert d.filter((F.col("part") == "train") != (F.col("time_index_norm") <= 0.7 * top)).count() == 0
    a = m.random_split(table, ["loc", "year", "month"]).select("loc", "year", "month", "part")
    b = m.random_split(table.repartition(7), ["loc", "year", "month"]).select("loc", "year", "month", "part")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    share = a.filter("part = 'test'").count() / 600
    assert 0.2 < share < 0.4
    x, y = m.features_and_target(table, "n", ["loc", "year", "month"])
    assert "n" not in x.columns and y.columns == ["loc", "year", "month", "n"]


def test_imputation_uses_the_training_median(table):
    train = table.filter("f >= 3")
    got = m.impute_median(table, ["f"], train).filter("n IS NOT NULL").select("f").collect()
    assert all(r["f"] is not None for r in got)
    assert m.impute_median(table.filter("f IS NULL"), ["f"], train).first()["f"] in (3.0, 3.5, 4.0)


def test_contributions_add_up(table):
    d = m.explain_contributions(table.fillna(0, ["f"]), {"f": 2.0, "time_index_norm": -1.0}, 0.5)
    bad = d.filter(F.abs(F.col("prediction") - (0.5 + 2 * F.col("f") - F.col("time_index_norm"))) > 1e-9)
    assert bad.count() == 0
    top = m.top_contributions(d.limit(1), ["loc"], ["f", "time_index_norm"], 1)
    assert top.count() == 2


def test_forecast_freezes_everything_but_the_month(table):
    out = m.forecast_template(table, "loc", "2025-11", "2026-02")
    assert out.count() == 12 * 4
    last = {r["loc"]: r["time_index_norm"] for r in table.groupBy("loc").agg(F.max("time_index_norm").alias("time_index_norm")).collect()}
    assert {(r["loc"], r["time_index_norm"]) for r in out.collect()} == set(last.items())
    assert {(r["year"], r["month"]) for r in out.collect()} == {(2025, 11), (2025, 12), (2026, 1), (2026, 2)}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = m.regression_metrics(df, "y", "p").first()
    assert r["mse"] == pytest.approx(5 / 3) and r["mae"] == pytest.approx(1.0)
    assert r["r2"] == pytest.approx(1 - 5 / 2) and r["explained_variance"] == pytest.approx(1 - (2 / 3) / (2 / 3))


def test_learners_and_search(table):
    keys, features = ["loc", "year", "month"], ["f", "time_index_norm"]
    boosted = m.train_boosted(table, features, "n", "loc", m.stable_fraction(keys) < 0.2, maxIter=3, maxDepth=3)
    assert m.forecast_months(table, "loc", "2025-01", "2025-02", model=boosted).count() == 24
    poisson = m.train_poisson(table, features, "n", "loc").transform(table)
    assert poisson.filter("prediction < 0").count() == 0
    forest = m.train_forest(table, features, "n", numTrees=3, maxDepth=3)
    assert {r["feature"] for r in m.importance_top(forest, features, table.sparkSession).collect()} == set(features)
    found = m.tune_random(table, features, "n", keys, trials=1, objectives=("poisson", "forest"),
                          spaces={"poisson": {"regParam": ("log", 0.01, 1.0)}, "forest": {"numTrees": ("int", 2, 3)}})
    assert found.filter("best").count() >= 1 and found.count() == 2


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        a, b = float(rng.uniform(-1, 1)), float(rng.uniform(-1, 1))
        n = int(rng.poisson(math.exp(1 + a + (b > 0) * 0.8 - (a > 0.5) * b)))
        rows.append((i, a if i % 11 else None, b, n, f"L{i % 5}"))
    return spark.createDataFrame(rows, "id long, a double, b double, n long, loc string").cache()


def test_boosted_poisson_learns_and_can_be_saved(counts, tmp_path):
    fitted = m.train_boosted_poisson(counts, ["a", "b"], "n", "loc", F.col("id") % 4 == 0, maxIter=25, stepSize=0.3, maxDepth=3, patience=5)
    learner = fitted.stages[-1]
    assert len(learner.trees) == len(learner.history) >= 5 and learner.history[-1] < 0.75 * learner.history[0]
    path = f"file://{tmp_path}/model"
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = {r.id: r.prediction for r in fitted.transform(counts).select("id", "prediction").collect()}
    b = {r.id: r.prediction for r in again.transform(counts).select("id", "prediction").collect()}
    assert a == b and min(a.values()) > 0
    assert m.forecast_months(counts.withColumns({"year": F.lit(2020), "month": F.lit(1)}), "loc", "2021-01", "2021-02",
                             model=fitted).count() == 10


def test_a_full_step_keeps_the_counts_of_every_leaf(counts):
    fitted = m.train_boosted_poisson(counts, ["b"], "n", maxIter=1, stepSize=1.0, maxDepth=3)
    done = fitted.transform(counts).groupBy(F.round("prediction", 9)).agg(F.sum("prediction").alias("p"), F.sum("n").alias("n")).collect()
    assert len(done) > 2 and all(r.p == pytest.approx(r.n) for r in done)
    with pytest.raises(ValueError):
        m.train_boosted_poisson(counts.withColumn("n", F.lit(0)), ["b"], "n", maxIter=1)


def test_contributions_of_fitted_trees_add_up(counts):
    models = {
        "forest": m.train_forest(counts, ["a", "b"], "n", numTrees=4, maxDepth=4),
        "boosted": m.train_boosted(counts, ["a", "b"], "n", "loc", maxIter=4, maxDepth=3),
        "poisson": m.train_boosted_poisson(counts, ["a", "b"], "n", "loc", maxIter=4, maxDepth=3)}
    for name, fitted in models.items():
        out = boosting.explain_fitted(counts, fitted)
        parts = [c for c in out.columns if c.startswith("contrib_")]
        assert parts == ["contrib_a", "contrib_b"] + ["contrib_location_effect"] * (name != "forest")
        for r in out.collect():
            score = math.log(r.prediction) if name == "poisson" else r.prediction
            assert r.base_value + sum(r[c] for c in parts) == pytest.approx(score, abs=1e-9)


def test_locations_are_joined_not_compared_one_by_one(spark):
    """As many locations as rows: the prepared rows carry no branch per location."""
    df = spark.range(3000).select(F.concat(F.lit("L"), "id").alias("loc"), (F.col("id") % 7).cast("double").alias("f"),
                                  (F.col("id") % 5).alias("n"))
    fitted = m.train_poisson(df, ["f"], "n", "loc")
    done = fitted.transform(df)
    assert len(done._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    mean = df.agg(F.avg("n")).first()[0]
    for r in done.limit(50).collect():
        assert r["location_effect"] == pytest.approx(r["n"] / 11 + mean * 10 / 11)
    new = spark.createDataFrame([("new", 1.0), (None, 1.0)], "loc string, f double")
    assert [r["location_effect"] for r in fitted.transform(new).collect()] == [pytest.approx(mean)] * 2
