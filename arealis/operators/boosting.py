"""Poisson boosting with log link, and additive explanations of fitted trees.

A boosted model is a margin: a start value and one regression tree a round. Each round
fits a Spark ML tree to the Newton step of every row (gradient over Hessian, weighted by
the Hessian) and then sets every leaf to the step that fits its counts exactly, so
that with a full step the predictions of a leaf add up to its counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from ..ship import ship

#: A leaf without any count lowers the prediction to this part of what it was, not to nothing.
LEAST_RATIO = 1e-3
#: Rounds after which the margins are written.
WRITE_EVERY = 10


@dataclass
class Tree:
    """Nodes of a binary tree in the order root, left part, right part; a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.feature < 0)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Leaf value of each row of ``x``; not-a-number goes to the right, as in training."""
        at = np.zeros(len(x), np.int64)
        inner = self.feature[at] >= 0
        while inner.any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            down = x[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(down, self.left[node], self.right[node])
            inner = self.feature[at] >= 0
        return self.value[at]


def read_tree(model) -> Tree:
    """Nodes of a fitted Spark ML regression tree (continuous splits), with the mean of each node's rows."""
    rows: list[list] = []

    def walk(node) -> int:
        own = len(rows)
        rows.append([-1, 0.0, -1, -1, float(node.prediction())])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                raise ValueError("the tree splits a category")
            rows[own][:2] = [int(split.featureIndex()), float(split.threshold())]
            rows[own][2] = walk(node.leftChild())
            rows[own][3] = walk(node.rightChild())
        return own

    walk(model._java_obj.rootNode())
    feature, threshold, left, right, value = zip(*rows)
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


# -- boosting -------------------------------------------------------------

class BoostedPoissonModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """exp(base + sum of the trees' leaf values); a stage that a pipeline can save."""

    def __init__(self, base: float = 0.0, trees: Sequence[Tree] = (), history: Sequence[float] = ()):
        super().__init__()
        self.base, self.trees = base, list(trees)
        #: Mean deviance of the validation rows (else of all rows) after each round.
        self.history = list(history)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def predict(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=float)
            x = np.stack(features.to_numpy()).astype(float)
            return pd.Series(np.exp(base + sum((tree.apply(x) for tree in trees), np.zeros(len(x)))))

        return ship(dataset).withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: BoostedPoissonModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"base": m.base, "history": m.history})
        rows = [(t, i, int(f), float(c), int(a), int(b), float(v)) for t, tree in enumerate(m.trees)
                for i, (f, c, a, b, v) in enumerate(zip(tree.feature, tree.threshold, tree.left, tree.right, tree.value))]
        self.sparkSession.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, "
                                          "value double").write.mode("overwrite").parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedPoissonModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        trees = [Tree(*(part[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")))
                 for _, part in nodes.groupby("tree")]
        model = BoostedPoissonModel(metadata["base"], trees, metadata["history"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def boost_poisson(rows: DataFrame, label: str, *, validation: str | None = None, maxIter: int = 100,
                  stepSize: float = 0.1, subsamplingRate: float = 1.0, patience: int = 10, seed: int = 42,
                  **tree_params) -> BoostedPoissonModel:
    """Boosted trees for counts ``label`` of ``rows`` with an assembled column ``features``.

    ``tree_params`` go to the regression tree of each round (``maxDepth``,
    ``minInstancesPerNode``, ..). With a boolean column ``validation`` the rows it marks are
    not learnt from; rounds stop when their deviance has not fallen for ``patience`` rounds,
    and the model is cut back to the best round. Rows without a label take no part.
    """
    y = F.col(label).cast("double")
    held = F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    state = cut_lineage(rows.filter(y.isNotNull()).select("features", y.alias("_y"), held.alias("_held")))
    start = state.filter("NOT _held").agg(F.avg("_y"), F.min("_y")).first()
    if start[0] is None or start[1] < 0 or start[0] <= 0:
        raise ValueError("the counts must not be negative nor all zero")
    base = math.log(start[0])
    state = state.withColumn("_margin", F.lit(base))
    trees, history = [], []
    deviance = 2 * (F.when(F.col("_y") > 0, F.col("_y") * (F.log("_y") - F.col("_margin"))).otherwise(0.0)
                    - F.col("_y") + F.exp("_margin"))
    for step in range(maxIter):
        now = state.withColumn("_mu", F.exp("_margin")).withColumn("_step", F.col("_y") / F.col("_mu") - 1)
        learn = now.filter("NOT _held")
        if subsamplingRate < 1:
            learn = learn.sample(False, subsamplingRate, seed + step)
        fitted = DecisionTreeRegressor(labelCol="_step", weightCol="_mu", leafCol="_leaf", predictionCol="_found",
                                       seed=seed, **tree_params).fit(learn)
        tree = read_tree(fitted)
        leaves = tree.leaves()
        placed = fitted.transform(now)
        sums = placed.filter("NOT _held").groupBy("_leaf").agg(F.sum("_y").alias("y"), F.sum("_mu").alias("mu")).collect()
        ratio = np.ones(len(leaves))
        for r in sums:
            ratio[int(r["_leaf"])] = max(r["y"] / r["mu"], LEAST_RATIO)
        tree.value = np.zeros(len(tree.feature))
        tree.value[leaves] = stepSize * np.log(ratio)
        trees.append(tree)
        steps = F.array(*[F.lit(float(v)) for v in tree.value[leaves]])
        state = placed.select("features", "_y", "_held", (F.col("_margin") + F.get(steps, F.col("_leaf").cast("int"))).alias("_margin"))
        if (step + 1) % WRITE_EVERY == 0:
            state = cut_lineage(state)
        history.append(float(state.filter("_held" if validation else "true").agg(F.avg(deviance)).first()[0] or 0.0))
        best = int(np.argmin(history))
        if validation and step - best >= patience:
            break
    if validation and trees:
        trees, history = trees[:best + 1], history[:best + 1]
    return BoostedPoissonModel(base, trees, history)


# -- explanations ---------------------------------------------------------

def _expected(tree: Tree, cover: np.ndarray | None = None) -> np.ndarray:
    """Value of each node: what is expected of a row that has come so far."""
    if cover is None:
        return tree.value
    value, weight = tree.value.copy(), cover.astype(float)
    for i in range(len(value) - 1, -1, -1):
        if tree.feature[i] >= 0:
            a, b = tree.left[i], tree.right[i]
            weight[i] = weight[a] + weight[b]
            value[i] = (value[a] * weight[a] + value[b] * weight[b]) / weight[i]
    return value


def path_contributions(tree: Tree, value: np.ndarray, columns: Sequence[Column]) -> Column:
    """Array of the parts of the features: each split adds the change of the expected value.

    The tree is compiled to one nested condition whose leaves are arrays of constants.
    """
    def compiled(node: int, parts: dict[int, float]) -> Column:
        f = int(tree.feature[node])
        if f < 0:
            return F.array(*[F.lit(float(parts.get(i, 0.0))) for i in range(len(columns))])
        a, b = (int(side[node]) for side in (tree.left, tree.right))
        low, high = ({**parts, f: parts.get(f, 0.0) + float(value[child] - value[node])} for child in (a, b))
        # In Spark's order not-a-number is above every number: it goes to the right, as in training.
        return F.when(columns[f] <= float(tree.threshold[node]), compiled(a, low)).otherwise(compiled(b, high))

    return compiled(0, {})


def explain_fitted(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds contrib_<feature> for every feature of a fitted tree model, base_value and prediction.

    base_value plus all contributions is the prediction; of a Poisson model its logarithm.
    The base is the expectation before any split, and a feature's part is what the splits
    on it change along the row's path in every tree. Works for single trees, forests and
    boosted trees; the expressions grow with the nodes of the model.
    """
    names = model.stages[-2].getInputCols()
    learner = model.stages[-1]
    if isinstance(learner, BoostedPoissonModel):
        trees, weights, base = learner.trees, [1.0] * len(learner.trees), learner.base
        trees_values = [_expected(t, np.ones(len(t.feature))) for t in trees]
    else:
        found = learner.trees if hasattr(learner, "trees") else [learner]
        trees, base = [read_tree(t) for t in found], 0.0
        weights = list(learner.treeWeights) if hasattr(learner, "treeWeights") else [1.0]
        if type(learner).__name__.startswith("RandomForest"):
            weights = [1.0 / len(trees)] * len(trees)
        trees_values = [_expected(t) for t in trees]
    done = model.transform(df)
    columns = [F.col(f"`{c}`").cast("double") for c in names]
    zero = F.array(*[F.lit(0.0)] * len(names))
    parts = [path_contributions(t, v * w, columns) for t, v, w in zip(trees, trees_values, weights)]
    total = F.aggregate(F.array(*parts), zero, lambda acc, p: F.zip_with(acc, p, lambda a, b: a + b)) if parts else zero
    base += float(sum(v[0] * w for v, w in zip(trees_values, weights)))
    plain = [c[:-len("_filled")] if c.endswith("_filled") else c for c in names]
    out = done.withColumn("_parts", total).withColumns(
        {**{f"contrib_{c}": F.col("_parts")[i] for i, c in enumerate(plain)}, "base_value": F.lit(base)})
    return out.drop("_parts", *[c for c in names if c.endswith("_filled")])
