"""The six-month look-back carried from snapshot to snapshot, so that a month costs a month of clicks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.plans.gold import CLICK_COLUMNS, LOOK_BACK, engagement_scaffold
from tidemark.sources import tables, versions

STATE_SCHEMA = ", ".join(["Customer_ID string", *[f"{c} int" for c in CLICK_COLUMNS], "last_seen date", "snapshot_date date"])


def months_after(month: dt.date, n: int) -> dt.date:
    at = month.year * 12 + month.month - 1 + n
    return dt.date(at // 12, at % 12 + 1, 1)


def advance(state: DataFrame, clicks: DataFrame, snapshot: dt.date, months: int = 1, order: str = "fe_1") -> DataFrame:
    """The states of the `months` snapshots after `snapshot`, from its state and the clicks from `snapshot` on.

    A state row is a customer's panel (click_1m is the month before the
    snapshot) and the last month in which the customer was seen. The old panel
    and the new clicks meet in one aggregation by customer: old columns move up
    by a month per snapshot, new months fill in below. Clicks are combined before
    the shuffle, so a customer with very many of them moves as one row per task,
    and it is the only shuffle. Who was not seen for six months is dropped.
    """
    offset = "12 * (year(snapshot_date) - {0}) + month(snapshot_date) - {1}".format(snapshot.year, snapshot.month)
    old = state.filter(F.col("snapshot_date") == as_date(snapshot)).select(
        "Customer_ID", *CLICK_COLUMNS, "last_seen", *[F.lit(None).cast("int").alias(c) for c in ("at", "fe_1", "place")])
    new = clicks.filter(F.col("snapshot_date").between(as_date(snapshot), as_date(months_after(snapshot, months - 1)))).select(
        "Customer_ID", *[F.lit(None).cast("int").alias(c) for c in CLICK_COLUMNS], F.lit(None).cast("date").alias("last_seen"),
        F.expr(offset).alias("at"), "fe_1", F.col(order).alias("place"))
    by_customer = old.withColumn("place", F.col("place").cast(new.schema["place"].dataType)).unionByName(new).groupBy("Customer_ID").agg(
        F.max("last_seen").alias("before"),
        *[F.max(c).alias(c) for c in CLICK_COLUMNS],
        *[F.expr(f"min_by(fe_1, place) filter (where at = {i})").cast("int").alias(f"m{i}") for i in range(months)],
        *[F.expr(f"bool_or(at = {i})").alias(f"seen{i}") for i in range(months)])
    values = ", ".join([*reversed(CLICK_COLUMNS), *[f"m{i}" for i in range(months)]])
    seen = ", ".join(f"if(seen{i}, add_months(date'{snapshot}', {i}), null)" for i in range(months))
    every = by_customer.select(
        "Customer_ID", "before", F.expr(f"array({values})").alias("v"), F.expr(f"array({seen})").alias("seen"),
        F.explode(F.sequence(F.lit(1), F.lit(months))).alias("t"))
    moved = every.select(
        "Customer_ID", *[F.expr(f"v[t + {LOOK_BACK - i}]").alias(f"click_{i}m") for i in range(1, LOOK_BACK + 1)],
        F.expr("greatest(before, array_max(slice(seen, 1, t)))").alias("last_seen"),
        F.expr(f"add_months(date'{snapshot}', t)").alias("snapshot_date"))
    return moved.filter(f"last_seen >= add_months(snapshot_date, -{LOOK_BACK})")


class CarriedPanel:
    """Engagement states of a run of monthly snapshots, published one snapshot at a time or several at once."""

    def __init__(self, spark: SparkSession, root: str, order: str = "fe_1"):
        self.spark, self.root, self.order = spark, root, order

    def state(self, start=None, end=None) -> DataFrame:
        return tables.read_or_empty(self.spark, self.root, STATE_SCHEMA, start, end)

    def newest(self) -> dt.date | None:
        """The last snapshot that has a state, from the manifest alone."""
        held = [p["snapshot_date"] for p in versions.partitions(self.spark, self.root)]
        return dt.date.fromisoformat(max(held)) if held else None

    def build(self, clicks: DataFrame, start: dt.date, end: dt.date, step: int = 12) -> None:
        """States of all snapshots from `start` to `end`: from the state before `start`, or from the clicks of the look-back before it."""
        at, back = months_after(start, -1), 0
        if (held := self.state(at, at)).isEmpty():
            # The state before all clicks of the look-back is empty; those between it and `start` are not whole, and not kept.
            at, held, back = months_after(start, -LOOK_BACK), tables.empty_table(self.spark, STATE_SCHEMA), LOOK_BACK - 1
        while at < end:
            months = min(step + back, (end.year - at.year) * 12 + end.month - at.month)
            last = months_after(at, months)
            made = advance(held, clicks, at, months, self.order).filter(F.col("snapshot_date") >= as_date(start))
            versions.publish(made, self.root, start=max(start, months_after(at, 1)), end=last)
            at, held, back = last, self.state(last, last), 0

    def late(self, clicks: DataFrame, month: dt.date, step: int = 12) -> None:
        """Clicks of `month` came late or changed: the states that look back on it, and those carried from them, are made again.

        The state of `month` itself does not depend on its clicks, and a state
        more than six months later would be the same again, so at most six are.
        """
        newest = self.newest()
        if newest is not None and newest > month:
            self.build(clicks, months_after(month, 1), min(newest, months_after(month, LOOK_BACK)), step)

    def panel(self, start=None, end=None) -> DataFrame:
        return self.state(start, end).select("Customer_ID", "snapshot_date", *CLICK_COLUMNS)


def engagement_store(carried: CarriedPanel, clicks: DataFrame, start, end) -> DataFrame:
    """`gold.engagement_store` from carried states."""
    return carried.panel(start, end).unionByName(engagement_scaffold(clicks, start, end))
