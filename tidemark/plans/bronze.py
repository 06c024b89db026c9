"""Raw text rows by snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.sources.schemas import RAW_FILES
from tidemark.sources.tables import read_raw
from tidemark.sources.versions import publish


def bronze(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Raw rows of a snapshot (`start` alone) or of a closed range of snapshots, text untouched.

    The snapshot date is the only typed column; it becomes the partition.
    """
    dated = raw.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    if start is None:
        return dated.filter(F.col("snapshot_date").isNotNull())
    return dated.filter(F.col("snapshot_date").between(as_date(start), as_date(end or start)))


def ingest(spark: SparkSession, raw_folder: str, source: str, out: str, start=None, end=None) -> None:
    """Split a raw CSV into the snapshot partitions of its bronze table."""
    raw = read_raw(spark, f"{raw_folder.rstrip('/')}/{RAW_FILES[source]}")
    publish(bronze(raw, start, end), out, start=start, end=end)
