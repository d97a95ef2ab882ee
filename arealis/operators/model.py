"""Split, train, tune, evaluate and forecast with Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import (GBTRegressor, GeneralizedLinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar as cal
from ..functions.scalars import clip_lower
from ..session import cut_lineage
from .boosting import boost_poisson
from .skew import exact_quantiles, stable_fraction
from .temporal import last_row_per_location

SEED = 42

# Search ranges of the tuned parameters (kind, low, high).
BOOSTED_SPACE = {"maxIter": ("int", 50, 500), "stepSize": ("float", 1e-4, 1.0),
                 "maxDepth": ("int", 2, 15), "subsamplingRate": ("float", 0.4, 1.0),
                 "minInstancesPerNode": ("int", 1, 10)}
FOREST_SPACE = {"numTrees": ("int", 100, 800), "maxDepth": ("int", 3, 30),
                "minInstancesPerNode": ("int", 1, 20),
                "featureSubsetStrategy": ("choice", ("sqrt", "log2", "0.5", "0.7", "1.0"))}
POISSON_SPACE = {"regParam": ("log", 1e-4, 3.0)}


# -- splits ---------------------------------------------------------------

def temporal_split(df: DataFrame, share: float = 0.7, index: str = "time_index_norm") -> DataFrame:
    """Adds ``part``: train up to the given share of the greatest time index, else test."""
    cutoff = df.select(F.max(index)).scalar() * share
    return df.withColumn("part", F.when(F.col(index) <= cutoff, "train").otherwise("test"))


def features_and_target(df: DataFrame, target: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """X (all but the target) and y. The keys stay in y: rows have no position to join on."""
    return df.drop(target), df.select(*keys, target)


def random_split(df: DataFrame, keys: Sequence[str], test_share: float = 0.3, seed: int = SEED) -> DataFrame:
    """Adds ``part`` by a hash of the row's key, the same on every run and cluster."""
    return df.withColumn("part", F.when(stable_fraction(keys, seed) < 1 - test_share, "train")
                         .otherwise("test"))


# -- preparation ----------------------------------------------------------

def impute_median(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """NULL -> exact median of the training rows, per column."""
    medians = exact_quantiles(df if train is None else train, columns, (0.5,))
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double"))
                           for c in columns})


class LocationEffect(Estimator):
    """Location as a numeric feature ``location_effect``: the mean target of its training rows,
    drawn towards the mean of all.

    Tree learners need ``maxBins`` of at least the number of levels; thousands of areas as
    bins would blow up the histograms, one encoded column does not. The means are a table
    that is joined: the encoder of the library compares every row with every location.
    """

    def __init__(self, location: str, label: str, smoothing: float = 10.0):
        super().__init__()
        self.location, self.label, self.smoothing = location, label, smoothing

    def _fit(self, dataset: DataFrame) -> LocationEffectModel:
        y = F.col(self.label).cast("double")
        rows = dataset.select(F.col(self.location).cast("string").alias("_loc"), F.when(~F.isnan(y), y).alias("_y"))
        effects = cut_lineage(_effects(rows, "_loc", F.col("_y"), self.smoothing, rows.select(F.avg("_y")).scalar()))
        overall = rows.agg(F.avg("_y")).first()[0]
        nowhere = effects.filter("_loc IS NULL").first()
        return LocationEffectModel(self.location, effects.filter("_loc IS NOT NULL"),
                                   nowhere["location_effect"] if nowhere else overall)


class LocationEffectModel(Model, MLWritable, MLReadable):
    """A stage that a pipeline can save; locations unknown or NULL have ``other``, the effect of the
    training rows without a location, or the mean of all where there were none."""

    def __init__(self, location: str = "loc", effects: DataFrame | None = None, other: float | None = None):
        super().__init__()
        self.location, self.effects, self.other = location, effects, other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.effects.select("_loc", F.col("location_effect").alias("_effect"))
        return dataset.join(found, F.col(self.location).cast("string") == F.col("_loc"), "left").withColumn(
            "location_effect", F.coalesce(F.col("_effect"), F.lit(self.other).cast("double"))).drop("_loc", "_effect")

    def write(self) -> MLWriter:
        return _LocationWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LocationReader()


class _LocationWriter(MLWriter):
    def __init__(self, instance: LocationEffectModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"location": m.location, "other": m.other})
        m.effects.write.mode("overwrite").parquet(f"{path}/effects")


class _LocationReader(MLReader):
    def load(self, path: str) -> LocationEffectModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        effects = self.sparkSession.read.parquet(f"{path}/effects")
        model = LocationEffectModel(metadata["location"], effects, metadata["other"])
        model._resetUid(metadata["uid"])
        return model


def _effects(df: DataFrame, location: str, y: Column, smoothing: float, overall: Column) -> DataFrame:
    """``location`` with its ``location_effect``."""
    weight = F.count(y) / (F.count(y) + F.lit(float(smoothing)))
    return df.groupBy(location).agg(weight.alias("_weight"), F.avg(y).alias("_mean")).select(
        location, (F.coalesce(F.col("_weight") * F.col("_mean"), F.lit(0.0)) + (1 - F.col("_weight")) * overall)
        .alias("location_effect"))


def encode_location(df: DataFrame, location: str, label: str, smoothing: float = 10.0) -> DataFrame:
    """Adds ``location_effect``: mean target of the location, drawn towards the mean of all.

    A grouped mean and a join: no list of locations on the driver or in a task. The
    trainers use ``LocationEffect``, the same as a stage that can be saved.
    """
    y = F.col(label).cast("double")
    effect = _effects(df, location, y, smoothing, df.select(F.avg(y)).scalar())
    return df.join(effect.select(F.col(location).alias("_loc"), "location_effect"),
                   F.col(location).eqNullSafe(F.col("_loc"))).drop("_loc")


def _preparation(features: Sequence[str], location: str | None, label: str) -> list:
    filled = [f"{c}_filled" for c in features]
    stages = [Imputer(strategy="median", inputCols=list(features), outputCols=filled)]
    if location is not None:
        stages = [LocationEffect(location, label)] + stages
        filled = filled + ["location_effect"]
    return stages + [VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep")]


# -- training -------------------------------------------------------------

def _fit_prepared(train: DataFrame, features: Sequence[str], label: str, location: str | None, learner,
                  *keep: str) -> PipelineModel:
    """Fits the preparation, writes the prepared rows once and fits the learner, which reads them many times."""
    ready = Pipeline(stages=_preparation(features, location, label)).fit(train)
    rows = cut_lineage(ready.transform(train).select("features", label, *keep))
    return PipelineModel(stages=[*ready.stages, learner.fit(rows)])


def train_forest(train: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    """Impute, assemble, random forest; the location is not a feature here."""
    learner = RandomForestRegressor(labelCol=label, seed=SEED, **params)
    return Pipeline(stages=_preparation(features, None, label) + [learner]).fit(train)


def train_boosted(train: DataFrame, features: Sequence[str], label: str, location: str | None = None,
                  validation: Column | None = None, **params) -> PipelineModel:
    """Gradient-boosted trees; with a validation condition, rounds stop early on it."""
    if validation is not None:
        train = train.withColumn("_validation", validation)
        params["validationIndicatorCol"] = "_validation"
    learner = GBTRegressor(labelCol=label, seed=SEED, **params)
    return _fit_prepared(train, features, label, location, learner, *([] if validation is None else ["_validation"]))


def train_poisson(train: DataFrame, features: Sequence[str], label: str, location: str | None = None,
                  **params) -> PipelineModel:
    """Poisson objective on counts with log link."""
    learner = GeneralizedLinearRegression(labelCol=label, family="poisson", link="log",
                                          **{"regParam": 0.01, "maxIter": 25, **params})
    return _fit_prepared(train, features, label, location, learner)


def train_boosted_poisson(train: DataFrame, features: Sequence[str], label: str, location: str | None = None,
                          validation: Column | None = None, **params) -> PipelineModel:
    """Boosted trees for counts: Poisson objective, log link (see ``boosting.boost_poisson``)."""
    ready = Pipeline(stages=_preparation(features, location, label)).fit(train)
    rows = ready.transform(train if validation is None else train.withColumn("_validation", validation))
    learner = boost_poisson(rows, label, validation=None if validation is None else "_validation",
                            **{"seed": SEED, **params})
    return PipelineModel(stages=[*ready.stages, learner])


def train_classifier(train: DataFrame, features: Sequence[str], label: str, location: str | None = None,
                     **params) -> PipelineModel:
    """Counts as classes: any values, any number of them.

    The learner sees the index of each class that the training rows have; ``prediction``
    is the class itself again.
    """
    index = StringIndexer(inputCol=label, outputCol="_class", handleInvalid="keep",
                          stringOrderType="alphabetAsc").fit(train)
    learner = RandomForestClassifier(labelCol="_class", predictionCol="_predicted", seed=SEED, **params)
    names = IndexToString(inputCol="_predicted", outputCol="_name", labels=index.labels)
    value = SQLTransformer(statement="SELECT *, CAST(_name AS DOUBLE) AS prediction FROM __THIS__")
    return Pipeline(stages=_preparation(features, location, label) + [index, learner, names, value]).fit(train)


TRAINERS = {"squared_error": train_boosted, "boosted_poisson": train_boosted_poisson, "poisson": train_poisson,
            "forest": train_forest}
SPACES = {"squared_error": BOOSTED_SPACE, "boosted_poisson": BOOSTED_SPACE, "poisson": POISSON_SPACE,
          "forest": FOREST_SPACE}


def draw(space: dict, rng: random.Random) -> dict:
    """One parameter set of a search space."""
    out = {}
    for name, (kind, *arg) in space.items():
        if kind == "int":
            out[name] = rng.randint(arg[0], arg[1])
        elif kind == "float":
            out[name] = rng.uniform(arg[0], arg[1])
        elif kind == "log":
            out[name] = arg[0] * (arg[1] / arg[0]) ** rng.random()
        else:
            out[name] = rng.choice(arg[0])
    return out


def tune_random(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], *,
                trials: int = 30, objectives: Sequence[str] = ("squared_error", "poisson"),
                spaces: dict | None = None, seed: int = SEED, test_share: float = 0.2) -> DataFrame:
    """Random search: every trial fits each objective, validated inside the training rows.

    Rows: trial, objective, params (JSON), rmse, best. The learning rows are cached
    for the whole search; only the scores reach the driver.
    """
    rng = random.Random(seed)
    parts = random_split(train.select(*keys, *features, label), keys, test_share, seed).persist()
    learn, check = parts.filter("part = 'train'"), parts.filter("part = 'test'")
    score = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    rows = []
    for trial in range(trials):
        for objective in objectives:
            params = draw((spaces or SPACES)[objective], rng)
            model = TRAINERS[objective](learn, features, label, **params)
            rows.append((trial, objective, json.dumps(params, sort_keys=True),
                         float(score.evaluate(model.transform(check)))))
    parts.unpersist()
    best = min(r[3] for r in rows)
    return train.sparkSession.createDataFrame(
        [(*r, r[3] == best) for r in rows],
        "trial int, objective string, params string, rmse double, best boolean")


def refit_best(train: DataFrame, features: Sequence[str], label: str, scores: DataFrame,
               location: str | None = None) -> PipelineModel:
    """The winner of ``tune_random``, fitted on all rows of ``train``."""
    best = scores.filter("best").orderBy("trial", "objective").first()
    options = {} if location is None or best["objective"] == "forest" else {"location": location}
    return TRAINERS[best["objective"]](train, features, label, **options, **json.loads(best["params"]))


def tune_halving(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], *,
                 candidates: int = 20, factor: int = 3, folds: int = 5, space: dict | None = None,
                 seed: int = SEED) -> DataFrame:
    """Successive halving over forest parameters, by cross-validated absolute error.

    Each round keeps the best ``1/factor`` of the candidates and uses ``factor``
    times the rows; the last round uses all of them.
    """
    rng = random.Random(seed)
    alive = [(i, draw(space or FOREST_SPACE, rng)) for i in range(candidates)]
    rounds = 1
    while factor ** rounds < candidates:
        rounds += 1
    rows = []
    for step in range(rounds + 1):
        share = float(factor) ** (step - rounds)
        sample = train.filter(stable_fraction(keys, seed) < share).select(*features, label).persist()
        learner = RandomForestRegressor(labelCol=label, seed=seed)
        stages = Pipeline(stages=_preparation(features, None, label) + [learner])
        grid = [{learner.getParam(k): v for k, v in params.items()} for _, params in alive]
        fitted = CrossValidator(
            estimator=stages, estimatorParamMaps=grid, numFolds=folds, seed=seed,
            evaluator=RegressionEvaluator(labelCol=label, metricName="mae")).fit(sample)
        sample.unpersist()
        ranked = sorted(zip(fitted.avgMetrics, alive), key=lambda r: (r[0], r[1][0]))
        rows += [(step, i, json.dumps(params, sort_keys=True), share, float(mae))
                 for mae, (i, params) in ranked]
        if len(alive) == 1:
            break
        alive = [c for _, c in ranked[:max(1, -(-len(alive) // factor))]]
    return train.sparkSession.createDataFrame(
        rows, "round int, candidate int, params string, row_share double, mae double")


# -- evaluation -----------------------------------------------------------

def clip_predictions(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.withColumn(prediction, clip_lower(F.col(prediction)))


def regression_metrics(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """MSE, RMSE, MAE, R-squared and explained variance in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    used = df.filter(y.isNotNull() & p.isNotNull())
    agg = used.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(F.pow(y - p, 2)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("_vy"), F.var_pop(y - p).alias("_vr"))
    return agg.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                      (1 - F.try_divide(F.col("mse"), F.col("_vy"))).alias("r2"),
                      (1 - F.try_divide(F.col("_vr"), F.col("_vy"))).alias("explained_variance"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, plus the accuracy.

    The data are reduced to the confusion matrix once; all rows of the report come
    from its few cells. Undefined ratios count as 0.
    """
    cells = confusion_matrix(df, label, prediction)
    sides = cells.select(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("chosen"),
                         F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(F.lit(0).cast("bigint")).alias("hit")
                         ).unionByName(
        cells.select(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("support"),
                     F.col("n").alias("chosen"), F.lit(0).cast("bigint").alias("hit")))
    per = sides.groupBy("c").agg(F.sum("support").alias("support"), F.sum("chosen").alias("chosen"),
                                 F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    per = per.select(
        F.col("c").cast("string").alias("class"), "hit",
        F.coalesce(F.try_divide(F.col("hit"), F.col("chosen")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("chosen") + F.col("support")), zero).alias("f1"),
        F.col("support").cast("bigint").alias("support"))
    measures = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                    F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"), *[
        F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"))
    accuracy = per.agg(F.lit("accuracy").alias("class"), *[
        F.try_divide(F.sum("hit"), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"))
    return (per.drop("hit").unionByName(accuracy).unionByName(macro).unionByName(weighted)
            .withColumn("support", F.col("support").cast("bigint")))


def importance_top(model: PipelineModel, features: Sequence[str], spark, n: int = 15) -> DataFrame:
    """Most important features of a tree model (a handful of numbers held by the model)."""
    values = model.stages[-1].featureImportances.toArray()
    names = list(features) + ["location_effect"] * (len(values) - len(features))
    return (spark.createDataFrame([(f, float(v)) for f, v in zip(names, values)],
                                  "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(n))


def explain_contributions(df: DataFrame, coefficients: dict[str, float], intercept: float,
                          means: DataFrame | None = None) -> DataFrame:
    """Additive contributions of a linear score: coef * (x - mean) per feature, and the
    base value (score of the mean row), so that base + sum = prediction."""
    source = df if means is None else means
    mean = source.select(F.struct(*[F.avg(c).alias(c) for c in coefficients])).scalar()
    base, total = F.lit(float(intercept)), F.lit(0.0)
    parts = {}
    for c, b in coefficients.items():
        part = F.lit(float(b)) * (F.col(c) - mean[c])
        parts[f"contrib_{c}"] = part
        base = base + F.lit(float(b)) * mean[c]
        total = total + part
    return df.withColumns({**parts, "base_value": base, "prediction": base + total})


def top_contributions(df: DataFrame, keys: Sequence[str], features: Sequence[str], n: int = 8) -> DataFrame:
    """The n greatest and the n smallest contributions of every case (ranked inside the row)."""
    def ranked(sign: int) -> Column:
        return F.array_sort(F.array(*[F.struct(
            (F.col(f"contrib_{f}") * sign).alias("order"), F.lit(f).alias("feature")) for f in features]))

    falling, rising = ranked(-1), F.transform(ranked(1), lambda e: e["feature"])
    long = df.select(*keys, rising.alias("_rising"), F.posexplode(falling).alias("_at", "_e"))
    return long.select(
        *keys, F.col("_e.feature").alias("feature"), (-F.col("_e.order")).alias("value"),
        (F.col("_at") + 1).alias("rank_positive"),
        F.array_position("_rising", F.col("_e.feature")).cast("int").alias("rank_negative")
    ).filter((F.col("rank_positive") <= n) | (F.col("rank_negative") <= n))


def sample_cases(df: DataFrame, keys: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """n cases in the order of a seeded hash of their key: the same on every run."""
    return df.orderBy(stable_fraction(keys, seed), *keys).limit(n)


# -- forecasting ----------------------------------------------------------

def forecast_template(df: DataFrame, location: str, start: str, end: str) -> DataFrame:
    """Latest row of each location repeated for every future month; only year and
    month change, all other features stay as last seen."""
    last = last_row_per_location(df, location, ["year", "month"])
    return (last.drop("year", "month").withColumn("_day", F.explode(cal.month_sequence(start, end)))
            .withColumns({"year": F.year("_day"), "month": F.month("_day")}).drop("_day"))


def forecast_months(df: DataFrame, location: str, start: str, end: str, *,
                    model: PipelineModel | None = None, score: Column | None = None) -> DataFrame:
    """(location, year, month, prediction) by a fitted model or a score expression."""
    rows = forecast_template(df, location, start, end)
    scored = model.transform(rows) if model is not None else rows.withColumn("prediction", score)
    return scored.select(location, "year", "month", F.col("prediction").cast("double").alias("prediction"))
