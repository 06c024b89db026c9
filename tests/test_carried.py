"""The carried look-back equals the one built at once, whatever the steps."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import job
from tidemark.plans import carried, gold
from tidemark.sources import versions

START, END = dt.date(2023, 3, 1), dt.date(2024, 8, 1)


@pytest.fixture(scope="module")
def clicks(spark):
    rnd = random.Random(8)
    rows = []
    for month in range(-8, 20):
        at = carried.months_after(dt.date(2023, 1, 1), month)
        for c in range(12):
            if rnd.random() < (0.1 if c < 4 else 0.5):
                rows += [(f"c{c}", rnd.choice([None, 1, 2, 3]), i, at) for i in range(rnd.choice([1, 1, 3]))]
        rows += [("busy", rnd.randrange(100), i, at) for i in range(60)]
    rows.append((None, 5, 1, START))
    return spark.createDataFrame(rows, "Customer_ID string, fe_1 int, event_id int, snapshot_date date").repartition(5).cache()


def rows_of(df):
    return Counter(map(tuple, df.select("Customer_ID", "snapshot_date", *gold.CLICK_COLUMNS).collect()))


@pytest.mark.parametrize("step", [1, 5, 40])
@pytest.mark.parametrize("order", ["fe_1", "event_id"])
def test_steps(spark, clicks, tmp_path, step, order):
    panel = carried.CarriedPanel(spark, f"file://{tmp_path}/p", order)
    panel.build(clicks, START, END, step)
    assert rows_of(panel.panel()) == rows_of(gold.engagement_panel(clicks, START, END, order))
    assert panel.newest() <= END


def test_going_on_reads_no_older_clicks(spark, clicks, tmp_path):
    panel = carried.CarriedPanel(spark, f"file://{tmp_path}/p")
    middle = dt.date(2023, 9, 1)
    panel.build(clicks, START, middle)
    later = clicks.filter(F.col("snapshot_date") >= F.lit(middle))
    panel.build(later, dt.date(2023, 10, 1), END)
    assert rows_of(panel.panel()) == rows_of(gold.engagement_panel(clicks, START, END))
    assert len(versions.numbers(spark, panel.root)) == 2


def test_a_late_month(spark, clicks, tmp_path):
    panel = carried.CarriedPanel(spark, f"file://{tmp_path}/p")
    month = dt.date(2023, 7, 1)
    panel.build(clicks.filter(F.col("snapshot_date") != F.lit(month)), START, END)
    assert rows_of(panel.panel()) != rows_of(gold.engagement_panel(clicks, START, END))
    before = versions.manifest(spark, panel.root)
    panel.late(clicks, month)
    assert rows_of(panel.panel()) == rows_of(gold.engagement_panel(clicks, START, END))
    after = versions.manifest(spark, panel.root)["partitions"]
    assert sorted(p for p, v in after.items() if before["partitions"].get(p) != v) == [
        f"snapshot_date={carried.months_after(month, i)}" for i in range(1, 7)]
    panel.late(clicks, END)  # nothing looks back on the newest snapshot yet
    assert versions.manifest(spark, panel.root)["partitions"] == after


def test_one_shuffle(spark, clicks):
    state = spark.createDataFrame([], carried.STATE_SCHEMA)
    for df in (carried.advance(state, clicks, START, 12), gold.engagement_panel(clicks, START, END)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        body = plan.split("InMemoryRelation")[0]
        assert body.count("Exchange hashpartitioning(Customer_ID") == 1, plan


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_busy_customers_are_reduced_first(clicks, hot_rows):
    for order in ("fe_1", "event_id"):
        assert rows_of(gold.engagement_panel(clicks, START, END, order, hot_rows)) == rows_of(
            gold.engagement_panel(clicks, START, END, order))


def test_no_clicks(spark, clicks, tmp_path):
    panel = carried.CarriedPanel(spark, f"file://{tmp_path}/p")
    panel.build(clicks.limit(0), START, END)
    assert panel.panel().count() == 0 and panel.newest() is None
    panel.late(clicks, START)
    assert carried.engagement_store(panel, clicks.limit(0), START, END).count() == 0


def test_the_job_carries_on(spark, clicks, tmp_path):
    store = job.Store(spark, f"file://{tmp_path}/mart")
    typed = clicks.drop("event_id").select("Customer_ID", *[F.col("fe_1").alias(f"fe_{i}") for i in range(1, 21)], "snapshot_date")
    store.write(typed, "silver/clickstream", "2022-01-01", "2024-12-31")
    for start, end in (("2023-03-01", "2023-08-31"), ("2023-09-01", "2024-08-01")):
        job.run_gold(store, start, end, carry=True)
    got = store.read("gold/engagement")
    assert rows_of(got) == rows_of(gold.engagement_store(typed, START, END))
