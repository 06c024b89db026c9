"""Writers. Rewriting a snapshot replaces its partition and leaves the others alone."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.schemas import DRIFT_SCHEMA, METRIC_SCHEMA


def write_snapshots(df: DataFrame, root: str, by=("snapshot_date",), start=None, end=None) -> None:
    """Overwrite the partitions present in `df`, and with `start` and `end` all snapshots between them.

    The rebalance brings the rows of one partition together for few output
    files and still splits a partition that is larger than the others. A stored
    snapshot from `start` to `end` that got no row is overwritten with an empty
    table; which ones got rows is observed during the write.
    """
    spark, ranged = df.sparkSession, start is not None and end is not None
    seen = Observation()
    rows = df.hint("rebalance", *by)
    if ranged:  # above the rebalance, as what lies below is taken out of the plan where there are no rows at all
        rows = rows.observe(seen, F.collect_set(F.col("snapshot_date").cast("string")).alias("dates"))
    rows.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)
    if ranged:
        # Partition values only: at most one row per snapshot.
        try:
            stored = spark.read.parquet(root)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return
        kept = stored.filter(F.col("snapshot_date").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
        body = StructType([f for f in stored.schema if f.name not in by])
        for row in kept.select(*by).distinct().collect():
            if str(row["snapshot_date"]) not in seen.get["dates"]:
                folder = "/".join(f"{c}={row[c]}" for c in by)
                spark.createDataFrame([], body).write.mode("overwrite").parquet(f"{root}/{folder}")


def write_predictions(df: DataFrame, root: str) -> None:
    write_snapshots(df, root, by=("model_id", "snapshot_date"))


def write_baseline_json(baseline: DataFrame, feature_cols, numeric_cols, path: str) -> None:
    """A model's bins as one JSON object: lists for the score, maps by column for the features.

    The baseline has a row per column, so it fits into one object.
    """
    feature = F.col("metric_kind") == "feature"

    def mapped(column):
        return F.map_from_entries(F.collect_list(F.when(feature, F.struct("feature", column))))

    baseline.agg(
        F.array(*[F.lit(c) for c in feature_cols]).alias("feature_cols"),
        F.array(*[F.lit(c) for c in numeric_cols]).alias("numeric_cols"),
        F.first(F.when(~feature, F.col("edges")), True).alias("score_bins"),
        F.first(F.when(~feature, F.col("expected")), True).alias("score_expected"),
        mapped("edges").alias("feature_bins"), mapped("expected").alias("feature_expected"),
    ).coalesce(1).write.mode("overwrite").json(path)


def write_drift(df: DataFrame, root: str) -> None:
    """Drift records as JSON lines, one folder per snapshot; rewriting a snapshot replaces the records of all its models."""
    fields = [c.split()[0] for c in DRIFT_SCHEMA.split(", ")]
    (
        df.select(*fields, F.col("snapshot_date").alias("snapshot"))
        .hint("rebalance", "snapshot").write.partitionBy("snapshot")
        .option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
        .mode("overwrite").json(root)
    )


def metric_rows(df: DataFrame, metrics: dict[str, Column], logged_at: Column | None = None) -> DataFrame:
    """One row per metric, snapshot and model; metrics without a value are left out."""
    at = F.current_timestamp() if logged_at is None else logged_at
    wide = df.select("snapshot_date", "model_id", at.alias("logged_at"),
                     *[c.cast("double").alias(name) for name, c in metrics.items()])
    return (
        wide.unpivot(["snapshot_date", "model_id", "logged_at"], list(metrics), "metric", "value")
        .filter(F.col("value").isNotNull())
        .select(*[c.split()[0] for c in METRIC_SCHEMA.split(", ")])
    )


def append_metrics(df: DataFrame, root: str) -> None:
    df.write.partitionBy("metric").mode("append").parquet(root)


def latest_metrics(df: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """The last sample of each metric, snapshot and model."""
    last = F.max(F.struct("logged_at", *([tiebreak] if tiebreak else []), "value"))
    return (
        df.groupBy("metric", "snapshot_date", "model_id").agg(last.alias("last"))
        .select("metric", "snapshot_date", "model_id", "last.value", "last.logged_at")
    )
