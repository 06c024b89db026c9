"""Training sets and scoring cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, training_windows
from tidemark.operators.joins import Colocated, left_join
from tidemark.operators.stratify import stratified_folds, stratified_split
from tidemark.sources.schemas import ID_COLUMNS
from tidemark.operators.summary import feature_columns


def features_only(features: DataFrame) -> DataFrame:
    """The feature store keyed by customer alone, as models read it."""
    return features.drop("snapshot_date")


def training_set(labels: DataFrame, features: DataFrame, train_date, train_months: int = 12,
                 oot_months: int = 2) -> DataFrame:
    """Label rows of both windows with the customer's features and `period` train_test or oot."""
    inside, period = _both_windows(train_date, train_months, oot_months)
    return left_join(labels.filter(inside).withColumn("period", period), features_only(features), "Customer_ID")


def _both_windows(train_date, train_months: int, oot_months: int):
    """Whether a snapshot lies in one of the windows, and in which."""
    w = training_windows(train_date, train_months, oot_months)
    date = F.col("snapshot_date")
    return date.between(w["train_test_start"], w["oot_end"]), F.when(date >= w["oot_start"], "oot").otherwise("train_test")


def lay_out(spark, root: str, labels: DataFrame, features: DataFrame, **sizes) -> Colocated:
    """Label and feature store by customer in the same buckets: training sets and cohorts then join in place."""
    return Colocated(spark, root).lay_out(labels, features_only(features), "Customer_ID", **sizes)


def training_set_in_place(stores: Colocated, train_date, train_months: int = 12, oot_months: int = 2) -> DataFrame:
    """`training_set` from stores that are laid out; no row is moved."""
    inside, period = _both_windows(train_date, train_months, oot_months)
    return stores.join(inside).withColumn("period", period)


def scoring_cohort_in_place(stores: Colocated, snapshot) -> DataFrame:
    """`scoring_cohort` from stores that are laid out."""
    return stores.join(F.col("snapshot_date") == as_date(snapshot)).drop("loan_id", "label", "label_def")


def model_features(df: DataFrame) -> list[str]:
    return feature_columns(df, [*ID_COLUMNS, "period", "split", "fold"])


def with_split(labels: DataFrame, keys=("loan_id",), train_date=None, train_ratio: float = 0.8, seed: int = 42,
               train_months: int = 12, oot_months: int = 2) -> DataFrame:
    """Label rows tagged train, test or oot; the split is exact per label."""
    w = training_windows(train_date, train_months, oot_months)
    date = F.col("snapshot_date")
    inside = labels.filter(date.between(w["train_test_start"], w["train_test_end"]))
    oot = labels.filter(date.between(w["oot_start"], w["oot_end"])).withColumn("split", F.lit("oot"))
    return stratified_split(inside, "label", list(keys), train_ratio, seed).unionByName(oot)


def with_folds(train: DataFrame, keys=("loan_id",), folds: int = 3, seed: int = 42) -> DataFrame:
    return stratified_folds(train, "label", list(keys), folds, seed)


def scoring_cohort(labels: DataFrame, features: DataFrame, snapshot) -> DataFrame:
    """Customers labelled at a snapshot with their features; the label itself is left out."""
    cohort = labels.filter(F.col("snapshot_date") == as_date(snapshot)).select("Customer_ID", "snapshot_date")
    return left_join(cohort, features_only(features), "Customer_ID")


def feature_snapshot(features: DataFrame, snapshot) -> DataFrame:
    """The feature rows of one snapshot as a cohort."""
    return features.filter(F.col("snapshot_date") == as_date(snapshot))
