"""Readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.dates import as_date, month_start
from tidemark.sources import versions
from tidemark.sources.schemas import BASELINE_JSON_SCHEMA, DRIFT_SCHEMA, RAW_COLUMNS


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV with every column as text.

    Names come from the header line, so column order and extra columns do not
    matter, and no pass over the data guesses types.
    """
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def one_snapshot(df: DataFrame, snapshot, column: str = "snapshot_date") -> DataFrame:
    return df.filter(F.col(column) == as_date(snapshot))


def between_dates(df: DataFrame, start, end, column: str = "snapshot_date") -> DataFrame:
    """Rows of a closed date range; prunes partitions when the column is one."""
    return df.filter(F.col(column).between(as_date(start), as_date(end)))


def read_snapshots(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """A snapshot table, or the partitions from `start` to `end`; absent months give no rows.

    A published table is read through its newest manifest. A partition column
    model_id is text, also where all ids look like numbers.
    """
    if versions.is_published(spark, root):
        df = versions.read_published(spark, root, start, end)
    else:
        df = spark.read.parquet(root)
    if "model_id" in df.columns and df.schema["model_id"].dataType != StringType():
        df = spark.read.schema(StructType(
            [StructField(f.name, StringType()) if f.name == "model_id" else f for f in df.schema])).parquet(root)
    if start is not None:
        df = df.filter(F.col("snapshot_date") >= as_date(start))
    if end is not None:
        df = df.filter(F.col("snapshot_date") <= as_date(end))
    return df


def empty_table(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, root: str, schema, start=None, end=None) -> DataFrame:
    """`read_snapshots`, or no rows where the table was never written or has no file yet."""
    try:
        return read_snapshots(spark, root, start, end)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty_table(spark, schema)


def empty_bronze(spark: SparkSession, source: str) -> DataFrame:
    """The bronze table of a source without rows."""
    return empty_table(spark, ", ".join(
        f"`{c}` {'date' if c == 'snapshot_date' else 'string'}" for c in RAW_COLUMNS[source]))


def read_drift(spark: SparkSession, *paths: str, snapshot=None, whole_files: bool = False) -> DataFrame:
    """Drift records, one JSON object per line; with `whole_files` each file is one object over any number of lines.

    With `snapshot` only the folder of that snapshot is read. Paths that do not
    exist hold no records.
    """
    fields = [field.split()[0] for field in DRIFT_SCHEMA.split(", ")]
    try:
        records = spark.read.schema(DRIFT_SCHEMA + ", snapshot string").option("multiLine", whole_files).json(list(paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, DRIFT_SCHEMA)
    if snapshot is not None:
        records = records.filter(F.col("snapshot") == F.lit(str(snapshot)))
    return records.select(*fields)


def read_baseline_json(spark: SparkSession, *paths: str) -> DataFrame:
    """Stored monitoring bins as rows (model file, metric_kind, feature, edges, expected)."""
    doc = (
        spark.read.schema(BASELINE_JSON_SCHEMA).option("multiLine", True).json(list(paths))
        .withColumn("source", F.input_file_name())
    )
    score = doc.select(
        "source",
        F.lit("score").alias("metric_kind"),
        F.lit("score").alias("feature"),
        F.col("score_bins").alias("edges"),
        F.col("score_expected").alias("expected"),
    )
    features = (
        doc.select("source", "feature_bins", "feature_expected", F.explode("numeric_cols").alias("feature"))
        .select(
            "source",
            F.lit("feature").alias("metric_kind"),
            "feature",
            F.element_at("feature_bins", F.col("feature")).alias("edges"),
            F.element_at("feature_expected", F.col("feature")).alias("expected"),
        )
    )
    return score.unionByName(features).filter(F.col("edges").isNotNull() & F.col("expected").isNotNull())


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths and modification times below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .load(root).select("path", "modificationTime")
    )


def snapshot_in_name(path: Column, stem: str, suffix: str = "parquet") -> Column:
    """Date in a name like stem_2024_09_01.parquet, NULL for other names."""
    parts = F.regexp_extract(path, rf"{stem}_(\d{{4}}_\d{{2}}_\d{{2}})\.{suffix}", 1)
    return F.replace(parts, F.lit("_"), F.lit("-")).try_cast("date")


def snapshot_months(df: DataFrame, upto=None, column: str = "snapshot_date") -> DataFrame:
    """Distinct months present in a table, up to a date; at most one row per calendar month."""
    if upto is not None:
        df = df.filter(F.col(column) <= as_date(upto))
    return df.select(month_start(F.col(column)).alias("month")).filter(F.col("month").isNotNull()).distinct()
