"""Label store and feature stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, months_before
from tidemark.functions.encode import at_least
from tidemark.functions.text import label_definition
from tidemark.operators.bounded import stored
from tidemark.operators.joins import left_join
from tidemark.sources.schemas import RISK_FEATURES

LOOK_BACK = 6
SAFE_DAY = 27  # the same day of the month in all months, and never the last
CLICK_COLUMNS = [f"click_{i}m" for i in range(1, LOOK_BACK + 1)]


def label_store(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Loans at one month on book, labelled by days past due; an unknown dpd is label 0."""
    return loans.filter(F.col("mob") == mob).select(
        "loan_id", "Customer_ID",
        at_least(F.col("dpd"), dpd).alias("label"),
        label_definition(dpd, mob).alias("label_def"),
        "snapshot_date",
    )


def _one_per_month(clicks: DataFrame) -> DataFrame:
    """The first row in `__place` of each customer, day of the month and month, where rows already lie by customer."""
    first = Window.partitionBy("Customer_ID", "day", "at").orderBy(F.col("__place").asc_nulls_last(), "fe_1")
    return clicks.withColumns({
        "day": F.dayofmonth("snapshot_date"), "at": F.expr("12 * year(snapshot_date) + month(snapshot_date)"),
    }).withColumn("__row", F.row_number().over(first)).filter("__row = 1").select(
        "Customer_ID", "day", "at", "snapshot_date", F.when(F.col("__place").isNotNull(), F.col("fe_1")).cast("int").alias("fe_1"))


def _served(monthly: DataFrame) -> DataFrame:
    """The panel rows of (Customer_ID, day, at, snapshot_date, fe_1), one row a month, made in the order of the months.

    A month makes the rows of the snapshots after it up to the next month that
    is there, six at most, so each row is made once and whole: its columns are the
    month and the five before it. Nothing is held but a few rows.
    """
    ordered = Window.partitionBy("Customer_ID", "day").orderBy("at")
    back = range(1, LOOK_BACK)
    near = monthly.select(
        "*", (F.lead("at").over(ordered) - F.col("at")).alias("__next"),
        *[F.lag(c, k).over(ordered).alias(f"__{c}_{k}") for k in back for c in ("at", "fe_1")])
    # Value of the month k months before: k rows hold at least k months, so it is among the last k.
    months = [F.col("fe_1"), *[
        F.coalesce(*[F.when(F.col(f"__at_{j}") == F.col("at") - k, F.col(f"__fe_1_{j}")) for j in range(1, k + 1)]) for k in back]]
    made = near.select(
        "Customer_ID", "day", "snapshot_date", F.array(*months).alias("__months"),
        F.explode(F.sequence(F.lit(1), F.least(F.lit(LOOK_BACK), F.col("__next")))).alias("__ahead"))
    return made.select(
        "Customer_ID", "day", F.add_months("snapshot_date", F.col("__ahead")).alias("snapshot_date"),
        *[F.get("__months", i - F.col("__ahead")).alias(c) for i, c in enumerate(CLICK_COLUMNS, 1)])


def engagement_panel(clicks: DataFrame, start, end, order: str = "fe_1", hot_rows: int = 1_000_000) -> DataFrame:
    """fe_1 of the six months before each snapshot of `start`..`end`, one row per customer.

    Rows are placed by customer once and sorted there by month; the reduction to
    one row per customer and month and the making of the panel run down that order
    without another shuffle or a table in memory. Customers with more than
    `hot_rows` rows, which are few, are reduced before it.
    """
    scan_from, scan_to = months_before(as_date(start), LOOK_BACK), months_before(as_date(end), 1)
    history = clicks.filter(F.col("snapshot_date").between(scan_from, scan_to)).select(
        "Customer_ID", "snapshot_date", "fe_1", F.col(order).alias("__place"))
    counted = stored(history.groupBy("Customer_ID").agg(F.count("*").alias("n"), F.max(F.dayofmonth("snapshot_date")).alias("day")).filter(
        (F.col("n") > hot_rows) | (F.col("day") > SAFE_DAY)))
    late = not counted.filter(F.col("day") > SAFE_DAY).isEmpty()
    hot = counted.filter(F.col("n") > hot_rows).select("Customer_ID")
    if late:
        hot = stored(hot)  # counted may then hold all customers
    first = F.min(F.struct(F.col("__place").isNull().alias("none"), "__place", "fe_1")).alias("first")
    reduced = history.join(hot, "Customer_ID", "left_semi").groupBy("Customer_ID", "snapshot_date").agg(first).select(
        "Customer_ID", "snapshot_date", "first.fe_1", "first.__place")
    placed = history.join(hot, "Customer_ID", "left_anti").unionByName(reduced).repartition("Customer_ID")
    columns = ["Customer_ID", "snapshot_date", *CLICK_COLUMNS]
    panel = _served(_one_per_month(placed)).filter(F.col("snapshot_date").between(as_date(start), as_date(end)))
    if not late:
        return panel.select(columns)
    # Days that a shorter month lacks fall on its last day, where they meet.
    met = panel.filter(F.col("day") > SAFE_DAY).groupBy("Customer_ID", "snapshot_date").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in CLICK_COLUMNS])
    return panel.filter(F.col("day") <= SAFE_DAY).select(columns).unionByName(met)


def engagement_scaffold(clicks: DataFrame, start, end) -> DataFrame:
    """Customers of snapshots for which no earlier month of the look-back exists, with empty columns."""
    months = clicks.filter(
        F.col("snapshot_date").between(months_before(as_date(start), LOOK_BACK), as_date(end))
    ).select("snapshot_date").distinct()
    served = months.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(LOOK_BACK)), lambda i: F.add_months("snapshot_date", i))).alias("snapshot_date"))
    without = stored(
        months.filter(F.col("snapshot_date") >= as_date(start)).join(served.distinct(), "snapshot_date", "left_anti"))
    customers = clicks.join(without, "snapshot_date", "left_semi").select("Customer_ID", "snapshot_date").distinct()
    return customers.select("*", *[F.lit(None).cast("int").alias(c) for c in CLICK_COLUMNS])


def engagement_store(clicks: DataFrame, start, end, order: str = "fe_1") -> DataFrame:
    """Engagement features of every monthly snapshot from `start` to `end`."""
    return engagement_panel(clicks, start, end, order).unionByName(engagement_scaffold(clicks, start, end))


def risk_store(financials: DataFrame, attributes: DataFrame) -> DataFrame:
    """Risk features of each financial row with Age and Occupation of all attribute rows of the customer.

    A customer with several attribute rows fans out, as the join has no date.
    """
    left = financials.select("Customer_ID", *RISK_FEATURES, "snapshot_date")
    right = attributes.select("Customer_ID", "Age", "Occupation")
    return left_join(left, right, "Customer_ID").select(
        "Customer_ID", *RISK_FEATURES, "Age", "Occupation", "snapshot_date")
