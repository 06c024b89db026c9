"""Exact distinct counts over any span of snapshots from stored bitmaps of dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.bounded import lookup, stored
from tidemark.session import write_and_reread
from tidemark.sources import claims, tables, versions

IDS_PER_BITMAP = 32_768  # of Spark's bitmap functions


def numbered(keys: DataFrame, key: str, after: int = 0) -> DataFrame:
    """(key, id): distinct keys with the numbers after + 1, after + 2, ... without a gap.

    The keys are written in parts, so that the numbers stay the same when a task
    runs again; a part's numbers start where the parts before it end.
    """
    spread = keys.repartition(key).select(key, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
    placed = write_and_reread(spread.withColumn("__at", F.col("__at").bitwiseAND((1 << 33) - 1)), "numbered")
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = stored(sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")))
    return lookup(placed, before, ["__part"]).select(key, (F.col("__at") + F.col("__before") + 1 + after).alias("id"))


def bitmaps(ids: DataFrame, by=()) -> DataFrame:
    """(by..., bucket, bits): the ids of each group, a bitmap of 4 KB for 32,768 of them.

    Bits are set per task before the shuffle, so a group of any size moves as
    at most one bitmap per task and bucket.
    """
    return ids.groupBy(*by, F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged(maps: DataFrame, by=()) -> DataFrame:
    """Bitmaps of the union of all groups that `by` does not tell apart."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(maps: DataFrame, by=(), name: str = "n_distinct") -> DataFrame:
    """How many ids the bitmaps of each group hold; groups must be merged first."""
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def over_spans(maps: DataFrame, spans: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """(spans' columns..., n_distinct): exact distinct counts of spans of snapshots, which may overlap; spans has first and last."""
    names = spans.columns
    inside = maps.join(spans, maps[date].between(spans["first"], spans["last"])).select(
        *[spans[c] for c in names], "bucket", "bits")
    return counted(merged(inside, names), names)


class DistinctStore:
    """Distinct keys per snapshot as bitmaps, and the dictionary of their dense ids.

        ROOT/ids       (key, id), only ever added to
        ROOT/bitmaps   (snapshot_date, bucket, bits), a snapshot replaced at a time

    One writer adds at a time, as it claims the dictionary first.
    """

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def ids(self, key_type: str = "string") -> DataFrame:
        return tables.read_or_empty(self.spark, f"{self.root}/ids", f"`{self.key}` {key_type}, id long, batch int")

    def bitmaps(self, start=None, end=None) -> DataFrame:
        return tables.read_or_empty(self.spark, f"{self.root}/bitmaps", "bucket long, bits binary, snapshot_date date", start, end)

    def add(self, df: DataFrame, start=None, end=None) -> None:
        """Bitmaps of the snapshots of `df`, (key, snapshot_date); a NULL key does not count.

        Keys are reduced to one per snapshot first. New ones get the next ids.
        """
        claim = claims.take(self.spark, f"{self.root}/writer", again=True)
        try:
            self._add(df, start, end)
        finally:
            claims.finish(self.spark, claim)

    def _add(self, df: DataFrame, start, end) -> None:
        key = self.key
        seen = write_and_reread(
            df.select(key, "snapshot_date").filter(F.col(key).isNotNull()).distinct(), "seen")
        known = self.ids(df.schema[key].dataType.simpleString())
        last = known.agg(F.coalesce(F.max("id"), F.lit(0)), F.coalesce(F.max("batch"), F.lit(0))).first()
        new = seen.select(key).distinct().join(known.select(key), key, "left_anti")
        versions.publish(numbered(new, key, last[0]).withColumn("batch", F.lit(last[1] + 1)), f"{self.root}/ids", ["batch"])
        known = self.ids(df.schema[key].dataType.simpleString()).drop("batch")
        versions.publish(bitmaps(seen.join(known, key), ["snapshot_date"]), f"{self.root}/bitmaps", start=start, end=end)

    def over_spans(self, spans: DataFrame) -> DataFrame:
        return over_spans(self.bitmaps(), spans)

    def cumulative(self) -> DataFrame:
        """(snapshot_date, n_distinct, n_new, n_so_far): keys of a snapshot, those never seen before it, and all up to it.

        What a snapshot adds to a bucket are the bits of all bitmaps up to it less
        those before it; a bucket has one bitmap per snapshot.
        """
        order = Window.partitionBy("bucket").orderBy("snapshot_date")
        filled = self.bitmaps().select(
            "snapshot_date", "bucket", F.bitmap_count("bits").alias("n"),
            F.bitmap_count(F.bitmap_or_agg("bits").over(order)).alias("upto"))
        added = filled.withColumn("new", F.col("upto") - F.coalesce(F.lag("upto").over(order), F.lit(0)))
        months = added.groupBy("snapshot_date").agg(F.sum("n").alias("n_distinct"), F.sum("new").alias("n_new"))
        return months.withColumn("n_so_far", F.sum("n_new").over(Window.orderBy("snapshot_date")))
