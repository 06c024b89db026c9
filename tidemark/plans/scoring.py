"""Boosted-tree training, parameter search and batch scoring."""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bounded import stored
from tidemark.operators.ranking import auc_and_gini, balanced_accuracy, positive_rate
from tidemark.operators.stability import psi_by_sample, quantile_edges
from tidemark.operators.summary import scaling_moments

# The search space.
SEARCH_SPACE = {
    "maxIter": [10, 25, 50],
    "maxDepth": [2, 3, 4],
    "stepSize": [0.01, 0.1, 1.0],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}
MISSING = -1e6


class BalancedAccuracyEvaluator(Evaluator):
    """Mean of the two class recalls of hard predictions."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol = Param(self, "labelCol", "label column")
        self.predictionCol = Param(self, "predictionCol", "prediction column")
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        row = balanced_accuracy(
            dataset, self.getOrDefault(self.predictionCol), self.getOrDefault(self.labelCol)).first()
        return float(row["balanced_accuracy"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def scaling_stage(train: DataFrame, features) -> SQLTransformer:
    """Standardising with the moments of the training rows, written into the model.

    One row of moments comes to the driver. Missing values move to a place far
    below every scaled value, where a tree can split them off.
    """
    m = scaling_moments(train, features).first()
    scaled = []
    for c in features:
        mean, scale = m[f"mean_{c}"] or 0.0, m[f"scale_{c}"]
        value = f"(CAST(`{c}` AS DOUBLE) - CAST({mean!r} AS DOUBLE)) / CAST({scale!r} AS DOUBLE)"
        scaled.append(f"COALESCE(NANVL({value}, NULL), CAST({MISSING} AS DOUBLE)) AS `__{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def tree_stages(features, label: str = "label", seed: int = 42, **params) -> list:
    assembler = VectorAssembler(inputCols=[f"__{c}" for c in features], outputCol="features")
    return [assembler, GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)]


def fit(train: DataFrame, features, label: str = "label", seed: int = 42, **params) -> PipelineModel:
    stages = [scaling_stage(train, features), *tree_stages(features, label, seed, **params)]
    return Pipeline(stages=stages).fit(train)


def draw_parameters(draws: int = 100, seed: int = 42, space=None) -> list[dict]:
    """Different parameter sets, drawn at random from the space."""
    space = space or SEARCH_SPACE
    total = 1
    for values in space.values():
        total *= len(values)
    chosen = []
    for at in random.Random(seed).sample(range(total), min(draws, total)):
        one = {}
        for name, values in space.items():
            at, pick = divmod(at, len(values))
            one[name] = values[pick]
        chosen.append(one)
    return chosen


def search(train: DataFrame, features, label: str = "label", fold: str = "fold", draws: int = 100,
           folds: int = 3, seed: int = 42, parallelism: int = 4, space=None) -> tuple[PipelineModel, dict, float]:
    """Random search over stratified folds; the best parameters are fitted again on all rows.

    `train` carries its fold number, see `dataset.with_folds`. It is read for every
    fold: hand in a stored table. Folds are cached by Spark ML, so they hold nothing
    but what trees and evaluator read.
    """
    scaling = Pipeline(stages=[scaling_stage(train, features)]).fit(train)
    assembler, trees = tree_stages(features, label, seed)
    grid = [{getattr(trees, k): v for k, v in p.items()} for p in draw_parameters(draws, seed, space)]
    validator = CrossValidator(
        estimator=Pipeline(stages=[assembler, trees]), estimatorParamMaps=grid,
        evaluator=BalancedAccuracyEvaluator(label), numFolds=folds, foldCol=fold,
        parallelism=parallelism, seed=seed)
    found: CrossValidatorModel = validator.fit(scaling.transform(train).select(label, fold, *assembler.getInputCols()))
    best = max(range(len(grid)), key=lambda i: found.avgMetrics[i])
    model = PipelineModel(stages=[*scaling.stages, *found.bestModel.stages])
    return model, {p.name: v for p, v in grid[best].items()}, found.avgMetrics[best]


def score(model: PipelineModel, df: DataFrame, name: str = "model_predictions") -> DataFrame:
    """Add the probability of class 1."""
    out = model.transform(df)
    added = [c for c in out.columns if c not in df.columns]
    return out.withColumn(name, F.get(vector_to_array("probability"), F.lit(1))).drop(*added)


def predictions(scored: DataFrame, model_name: str, model_id: str | Column) -> DataFrame:
    """The prediction table: customer, probability, model and snapshot."""
    return scored.select(
        "Customer_ID", "model_predictions", F.lit(model_name).alias("model_name"),
        (F.lit(model_id) if isinstance(model_id, str) else model_id).alias("model_id"), "snapshot_date")


def split_performance(scored: DataFrame, score_col: str = "model_predictions", label: str = "label",
                      split: str = "split") -> DataFrame:
    """(split, n, positive_rate, auc, gini) of train, test and oot rows."""
    ranked = auc_and_gini(scored, score_col, label, [split], places=3).select(split, "auc", "gini")
    return positive_rate(scored, label, [split]).join(ranked, split, "left")


def split_stability(scored: DataFrame, features, others=("test", "oot"), score_col: str = "model_predictions",
                    split: str = "split", bins: int = 10) -> DataFrame:
    """(compared, psi_score, csi_mean, csi_max) of each other split against the train rows.

    Where deciles of the score tie, its edges are taken again for as many bins
    as were left. Reads `scored` several times: hand in a stored table.
    """
    columns, train = [score_col, *features], scored.filter(F.col(split) == "train")
    edges = stored(quantile_edges(train, columns, bins).drop("n"))
    is_score = F.col("feature") == score_col
    found = edges.filter(is_score).select(F.size("edges") - 1).first()
    if found and 0 < found[0] < bins:
        again = stored(quantile_edges(train, [score_col], found[0]).drop("n"))
        edges = edges.filter(~is_score).unionByName(again)
    psi = psi_by_sample(scored, columns, split, "train", list(others), bins, edges)
    known = F.when(~F.isnan("psi"), F.col("psi"))
    return psi.groupBy(F.col("sample").alias("compared")).agg(
        F.max(F.when(is_score, known)).alias("psi_score"),
        F.avg(F.when(~is_score, known)).alias("csi_mean"),
        F.max(F.when(~is_score, known)).alias("csi_max"))
