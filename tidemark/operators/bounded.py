"""Per-group summaries, joins against them, and running totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import write_and_reread


def stored(df: DataFrame) -> DataFrame:
    """A per-group summary, written once.

    Later steps read the written table instead of running the summary again. Its
    size on disk is known to Spark, which broadcasts it in a join only below
    spark.sql.autoBroadcastJoinThreshold.
    """
    return write_and_reread(df, "summary")


def lookup(df: DataFrame, small: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Add the columns of `small` to each row; NULL keys match NULL keys.

    Without keys `small` is one row, read once as a scalar subquery.
    """
    keys = list(keys)
    added = [c for c in small.columns if c not in keys]
    if not keys:
        one = df.select("*", small.select(F.struct(*added)).scalar().alias("__one"))
        return one.select(*df.columns, *[F.col(f"__one.{c}").alias(c) for c in added])
    other = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return df.join(other, match, how).drop(*[f"__{k}" for k in keys])


def to_long(df: DataFrame, keys, columns) -> DataFrame:
    """One row (keys, feature, value) per listed column, values as doubles."""
    keys, columns = list(keys), list(columns)
    wide = df.selectExpr(*[f"`{k}`" for k in keys], *[f"double(`{c}`) as `{c}`" for c in columns])
    return wide.unpivot(keys, columns, "feature", "value")


def known_values(long: DataFrame) -> DataFrame:
    return long.filter("value is not null and not isnan(value)")


def feature_spine(spark, columns) -> DataFrame:
    """One row per listed column, for features that have no data at all."""
    return spark.createDataFrame([(c,) for c in columns], "feature string")


def running_total(df: DataFrame, by, order: str, amount: str, name: str) -> DataFrame:
    """Add `name`: the sum of `amount` over the rows of the group up to this one, in ascending order.

    A range exchange cuts groups and order into parts of like size, so a large
    group is ranked by many tasks; totals of the earlier parts, a row per group
    and part, give the rest. The written table fixes the parts: a task that runs
    again after an executor is lost meets the same ones. Rows are meant to be
    distinct in group and order.
    """
    by = list(by)
    placed = write_and_reread(
        df.repartitionByRange(*by, order).withColumn("__part", F.spark_partition_id()), "placed")
    earlier = Window.partitionBy(*by).orderBy("__part")
    before = stored(
        placed.groupBy(*by, "__part").agg(F.sum(amount).alias("__sum"))
        .select(*by, "__part", (F.sum("__sum").over(earlier) - F.col("__sum")).alias("__before")))
    upto = Window.partitionBy(*by, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = placed.withColumn(name, F.sum(amount).over(upto))
    return lookup(here, before, [*by, "__part"]).withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")
