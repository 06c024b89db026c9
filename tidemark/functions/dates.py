"""Snapshot calendar arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A date column from a column, a `date` or an ISO text."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(value.isoformat() if isinstance(value, date) else value).cast("date")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM").cast("date")


def months_before(d: Column, months: Column | int) -> Column:
    """`months` earlier on the same day, clamped to the end of a shorter month."""
    back = months if isinstance(months, Column) else F.lit(months)
    return F.add_months(d, -back)


def is_quarter_month(d: Column, months=(3, 6, 9, 12)) -> Column:
    return F.month(d).isin(*months)


def path_suffix(d: Column) -> Column:
    """2024-09-01 as 2024_09_01."""
    return F.date_format(d, "yyyy_MM_dd")


def month_calendar(spark: SparkSession, start, end, name: str = "snapshot_date") -> DataFrame:
    """First-of-month dates from the month of `start` up to `end`."""
    months = F.sequence(month_start(as_date(start)), as_date(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))


def calendar_spans(spark: SparkSession, start, end, unit: str) -> DataFrame:
    """(span, first, last) of each whole "quarter", "year" or other unit of `trunc` that `start`..`end` touches."""
    first = F.trunc("snapshot_date", unit).cast("date")
    spans = month_calendar(spark, start, end).groupBy(first.alias("first")).agg(F.count("*"))
    step = {"quarter": 3, "year": 12, "month": 1}[unit]
    return spans.select(F.lit(unit).alias("span"), "first", F.date_sub(F.add_months("first", step), 1).alias("last"))


def rolling_spans(spark: SparkSession, start, end, months: int) -> DataFrame:
    """(first, last) of the `months` calendar months that end with each month of `start`..`end`."""
    return month_calendar(spark, start, end, "month").select(
        F.add_months("month", 1 - months).alias("first"), F.last_day("month").alias("last"))


def training_windows(train_date, train_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """The closed date windows that belong to one training date.

    The out-of-time window is the `oot_months` before the date; the train/test
    window is the `train_months` before that.
    """
    d = as_date(train_date)
    oot_start = months_before(d, oot_months)
    return {
        "train_test_start": months_before(oot_start, train_months),
        "train_test_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(d, 1),
    }
