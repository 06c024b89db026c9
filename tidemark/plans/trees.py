"""Boosted trees as a table of nodes, scored by generated expressions."""

from __future__ import annotations

from collections import defaultdict

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

NODE_SCHEMA = (
    "tree int, weight double, node int, feature string, threshold double, left int, right int, value double, rows long, gain double"
)


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per node of the boosted trees of a saved pipeline, see NODE_SCHEMA.

    Node 0 is a tree's root. An inner node has a feature and a threshold, and
    rows at or below it go left; a leaf has neither and no children, and its
    value counts. rows and gain tell how many training rows met the node and what
    its split gained. Splits on categories are refused: the pipelines here have none.
    """
    model = PipelineModel.load(path)
    inputs = next(s.getInputCols() for s in model.stages if s.__class__.__name__ == "VectorAssembler")
    stage = next(n for n, _ in files.names(spark, f"{path}/stages") if "_GBTClassifier_" in n)
    weights = spark.read.parquet(f"{path}/stages/{stage}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    plain = F.when(node["split"]["numCategories"] >= 0, F.raise_error(F.lit("a split on categories"))).otherwise(
        node["split"]["leftCategoriesOrThreshold"][0])
    nodes = spark.read.parquet(f"{path}/stages/{stage}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(inner, F.get(F.array(*[F.lit(c) for c in inputs]), node["split"]["featureIndex"])).alias("feature"),
        F.when(inner, plain).alias("threshold"), F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"), node["prediction"].alias("value"), node["rawCount"].alias("rows"),
        F.when(inner, node["gain"]).alias("gain"))
    return nodes.join(weights, "tree").select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def margin(nodes: DataFrame) -> Column:
    """The weighted sum over trees of the value of the leaf that a row reaches.

    The nodes come to the driver; they are as many as the model has. A missing
    feature goes right, as no comparison holds for it.
    """
    trees, weights = defaultdict(dict), {}
    for r in nodes.collect():
        trees[r["tree"]][r["node"]] = r
        weights[r["tree"]] = r["weight"]

    def reached(held, at):
        r = held[at]
        if r["feature"] is None:
            return F.lit(float(r["value"]))
        below = F.col(r["feature"]).cast("double") <= F.lit(float(r["threshold"]))
        return F.when(below, reached(held, r["left"])).otherwise(reached(held, r["right"]))

    total = F.lit(0.0)
    for tree in sorted(trees):
        total = total + F.lit(float(weights[tree])) * reached(trees[tree], 0)
    return total


def score(nodes: DataFrame, df: DataFrame, name: str = "model_predictions") -> DataFrame:
    """Add the probability of class 1 of the trees, whose features are columns of `df`."""
    return df.withColumn(name, 1 / (1 + F.exp(-2 * margin(nodes))))


def score_saved(spark: SparkSession, path: str, df: DataFrame, name: str = "model_predictions") -> DataFrame:
    """`scoring.score` of a saved pipeline from its nodes: scaling and trees in one projection."""
    scaling = next(s for s in PipelineModel.load(path).stages if s.__class__.__name__ == "SQLTransformer")
    scaled = scaling.transform(df)
    return score(node_table(spark, path), scaled, name).select(*df.columns, name)


def feature_gains(nodes: DataFrame) -> DataFrame:
    """(feature, splits, gain): how often a feature is split on, and its share of the trees' weighted gain."""
    per = nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(
        F.count("*").alias("splits"), F.sum(F.col("weight") * F.col("gain") * F.col("rows")).alias("gain"))
    whole = per.agg(F.sum("gain").alias("whole"))
    return per.select("feature", "splits", (F.col("gain") / whole.scalar()).alias("gain"))
