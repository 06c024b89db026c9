"""Standardising, score summaries and table profiles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.numeric import drop_nan
from tidemark.operators.bounded import lookup, stored
from tidemark.operators.quantiles import exact_quantiles

SCORE_PERCENTILES = (1, 5, 10, 50, 90, 95, 99)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def other_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, NumericType) and f.name not in exclude]


def feature_columns(df: DataFrame, ids) -> list[str]:
    return [c for c in df.columns if c not in ids]


def scaling_moments(df: DataFrame, columns) -> DataFrame:
    """One row (mean_<c>, scale_<c>, ...) over the known values; a constant column scales by 1."""
    parts = []
    for c in columns:
        known = drop_nan(F.col(c))
        parts += [F.avg(known).alias(f"mean_{c}"),
                  F.coalesce(F.nullif(F.stddev_pop(known), F.lit(0.0)), F.lit(1.0)).alias(f"scale_{c}")]
    return df.agg(*parts)


def standardise(df: DataFrame, columns, moments: DataFrame) -> DataFrame:
    """Centre and scale the columns by fitted moments; missing values stay missing."""
    out = lookup(df, moments, [])
    scaled = {c: (F.col(c).cast("double") - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in columns}
    return out.withColumns(scaled).drop(*moments.columns)


def score_summary(df: DataFrame, score: str, by=()) -> DataFrame:
    """(by..., n, mean, std, min, p01, ..., p99, max) of a score column."""
    by = list(by)
    value = drop_nan(F.col(score))
    plain = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    q = exact_quantiles(df, [score], [p / 100 for p in SCORE_PERCENTILES], by)
    q = q.select(*by, *[F.get("quantiles", F.lit(i)).alias(f"p{p:02d}") for i, p in enumerate(SCORE_PERCENTILES)])
    joined = lookup(plain, q, by, "left")
    names = ["mean", "std", "min", *[f"p{p:02d}" for p in SCORE_PERCENTILES], "max"]
    return joined.select(*by, "n", *names)


def column_counts(df: DataFrame, columns=None) -> DataFrame:
    """(column, n_rows, n_known, n_missing) for each column, in one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    return wide.unpivot(["n_rows"], columns, "column", "n_known").select(
        "column", "n_rows", "n_known", (F.col("n_rows") - F.col("n_known")).alias("n_missing"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """(n_rows, n_distinct, n_repeated) of a key column."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_distinct")).withColumn(
        "n_repeated", F.col("n_rows") - F.col("n_distinct"))


def top_values(df: DataFrame, column: str, k: int = 25) -> DataFrame:
    """The k most frequent values with NULL as a value, ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), F.asc_nulls_last("value")).limit(k)


TRACKED_MOST = 1_000_000  # of Spark's frequent-items sketch


def frequent_values(df: DataFrame, column: str, k: int = 25, tracked: int = 4_096) -> DataFrame:
    """`top_values` of a column of very many values, exact, without a shuffle of them all.

    A frequent-items sketch of bounded size names candidates, which are then
    counted exactly. A value that it does not name has at most 7 / s of the rows,
    where s is the size of its table; if the k-th candidate has more, or the
    candidates are all there is, the answer is certain. Otherwise the sketch is
    made eight times as large. Where the largest one leaves a doubt, no value
    stands out, and all of them are counted. `df` is read twice a round: hand in
    a stored table.
    """
    values = df.select(F.col(column).alias("value"))
    while tracked <= TRACKED_MOST:
        named = stored(values.agg(F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("top")).select(
            F.expr("inline(top)")).select(F.col("item").alias("value")).distinct())
        match = values["value"].eqNullSafe(named["value"])
        counts = stored(values.join(named, match, "left_semi").groupBy("value").agg(F.count("*").alias("rows")))
        top = counts.orderBy(F.desc("rows"), F.asc_nulls_last("value")).limit(k)
        least, found = top.agg(F.min("rows"), F.count("*")).first()
        whole, covered = values.count(), counts.agg(F.sum("rows")).first()[0] or 0
        size = 1 << math.ceil(math.log2(tracked / 0.75))
        if covered == whole or (found == k and least > 7 * whole / size):
            return top
        tracked *= 8
    return top_values(df, column, k)


def first_rows(df: DataFrame, order, k: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(k)


def rows_missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())
