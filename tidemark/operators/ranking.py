"""Ranking and confusion measures of binary scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import drop_nan, gini
from tidemark.operators.bounded import running_total


def roc_auc(df: DataFrame, score: str, label: str, by=()) -> DataFrame:
    """(by..., n_pos, n_neg, auc) with ties counted half; NULL when a class is absent.

    Rows are first counted per distinct score; a running total of the negatives
    over the ascending scores then tells how many each positive beats.
    """
    by = list(by)
    rows = df.select(*by, drop_nan(F.col(score)).alias("score"), F.col(label).cast("int").alias("label"))
    rows = rows.dropna(subset=["score", "label"])
    counted = rows.groupBy(*by, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    ranked = running_total(counted, by, "score", "neg", "upto")
    won = F.col("pos") * (F.col("upto") - F.col("neg") / 2)
    return (
        ranked.groupBy(*by)
        .agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(won).alias("won"))
        .withColumn("auc", F.try_divide("won", F.col("n_pos").cast("double") * F.col("n_neg")))
        .drop("won")
    )


def auc_and_gini(df: DataFrame, score: str, label: str, by=(), places: int | None = None) -> DataFrame:
    """`roc_auc` with gini = 2 auc - 1, rounded where `places` is given."""
    g = gini(F.col("auc"))
    return roc_auc(df, score, label, by).withColumn("gini", g if places is None else F.round(g, places))


def balanced_accuracy(df: DataFrame, prediction: str, label: str, by=()) -> DataFrame:
    """(by..., tpr, tnr, balanced_accuracy): the AUC of hard 0/1 predictions."""
    def rate(value):
        hit = (F.col(label) == value) & (F.col(prediction) == value)
        return F.try_divide(F.count_if(hit), F.count_if(F.col(label) == value))

    return df.groupBy(*by).agg(rate(1).alias("tpr"), rate(0).alias("tnr")).withColumn(
        "balanced_accuracy", (F.col("tpr") + F.col("tnr")) / 2)


def positive_rate(df: DataFrame, label: str, by=(), places: int = 2) -> DataFrame:
    """(by..., n, positive_rate) with the rate rounded."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.avg(label), places).alias("positive_rate"))
