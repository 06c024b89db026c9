"""Drift and performance of scored snapshots, all snapshots in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.decisions import (
    AUC_FLOOR, CSI_LIMIT, GINI_FLOOR, PSI_LIMIT, drift_flags, newest_predictions, performance_decision,
    performance_flags, reaches,
)
from tidemark.operators.bin_state import bin_state, over_spans, psi_of_state
from tidemark.operators.ranking import auc_and_gini
from tidemark.operators.stability import psi_against_baseline
from tidemark.sources.sinks import metric_rows

KEYS = ["snapshot_date", "model_id"]
BY_MODEL = ["model_id", "snapshot_date"]


def drift_records(scored: DataFrame, features, baseline: DataFrame, score: str = "score", baseline_by=(),
                  psi_limit: float = PSI_LIMIT, csi_limit: float = CSI_LIMIT) -> DataFrame:
    """A drift record for each snapshot and model of (snapshot_date, model_id, score, features...).

    The score column carries the name it has in the baseline.
    """
    psi = psi_against_baseline(scored, [score, *features], baseline, KEYS, baseline_by)
    return drift_flags(_indices(psi, KEYS), psi_limit, csi_limit)


def _indices(psi: DataFrame, by) -> DataFrame:
    """(by..., psi_score, csi_mean, csi_max): the index of the score, mean and maximum of the features'."""
    is_score = F.col("metric_kind") == "score"
    known = F.when(~F.isnan("psi"), F.col("psi"))
    return psi.groupBy(*by).agg(
        F.max(F.when(is_score, known)).alias("psi_score"),
        F.avg(F.when(~is_score, known)).alias("csi_mean"),
        F.max(F.when(~is_score, known)).alias("csi_max"),
    )


def scored_state(scored: DataFrame, features, baseline: DataFrame, score: str = "score", baseline_by=()) -> DataFrame:
    """Counts per snapshot, model, column and bin: all that drift needs to know of scored rows."""
    return bin_state(scored, [score, *features], baseline, KEYS, baseline_by)


def drift_from_state(state: DataFrame, baseline: DataFrame, baseline_by=(), psi_limit: float = PSI_LIMIT,
                     csi_limit: float = CSI_LIMIT) -> DataFrame:
    """`drift_records` from the counts alone."""
    return drift_flags(_indices(psi_of_state(state, baseline, KEYS, baseline_by), KEYS), psi_limit, csi_limit)


def span_drift(state: DataFrame, spans: DataFrame, baseline: DataFrame, baseline_by=(), psi_limit: float = PSI_LIMIT,
               csi_limit: float = CSI_LIMIT) -> DataFrame:
    """(spans' columns..., model_id, psi_score, csi_mean, csi_max, psi_breach, csi_breach) of each span of snapshots and model.

    The snapshots of a span count as one sample; `spans` has first and last.
    """
    by = [*spans.columns, "model_id"]
    psi = psi_of_state(over_spans(state, spans, ["model_id"]), baseline, by, baseline_by)
    return _indices(psi, by).withColumns({
        "psi_breach": reaches(F.col("psi_score"), F.lit(psi_limit)), "csi_breach": reaches(F.col("csi_max"), F.lit(csi_limit))})


def performance_records(predictions: DataFrame, labels: DataFrame, auc_floor: float = AUC_FLOOR,
                        gini_floor: float = GINI_FLOOR) -> DataFrame:
    """(snapshot_date, model_id, n_pos, n_neg, auc, gini, flags, decision) of the newest predictions.

    Predictions meet the labels of the same customer and snapshot; rows without
    a label, a prediction or a partner do not count.
    """
    newest = newest_predictions(predictions).select(*KEYS, "Customer_ID", "model_predictions")
    matched = newest.join(labels.select("snapshot_date", "Customer_ID", "label"), ["snapshot_date", "Customer_ID"])
    matched = matched.dropna(subset=["model_predictions", "label"])
    flagged = performance_flags(auc_and_gini(matched, "model_predictions", "label", KEYS), auc_floor, gini_floor)
    return flagged.withColumn("decision", performance_decision(F.col("breach")))


def record_json(df: DataFrame, columns) -> DataFrame:
    """(keys, record): the listed columns as one flat JSON object."""
    return df.select(*KEYS, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record"))


def drift_metrics(records: DataFrame, logged_at=None) -> DataFrame:
    """Drift records as gauge samples."""
    dated = records.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    return metric_rows(dated, {
        "ml_psi_score": F.col("psi_score"), "ml_csi_max": F.col("csi_max"),
        "ml_psi_threshold": F.col("psi_threshold"), "ml_csi_threshold": F.col("csi_threshold"),
    }, logged_at)


def performance_metrics(records: DataFrame, logged_at=None, auc_floor: float = AUC_FLOOR,
                        gini_floor: float = GINI_FLOOR) -> DataFrame:
    """Performance records as gauge samples."""
    return metric_rows(records, {
        "ml_auc": F.col("auc"), "ml_gini": F.col("gini"),
        "ml_auc_threshold": F.lit(auc_floor), "ml_gini_threshold": F.lit(gini_floor),
    }, logged_at)
