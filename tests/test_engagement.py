"""The engagement panel made in the order of the months, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import gold

START, END = dt.date(2000, 1, 1), dt.date(2001, 6, 30)
SCHEMA = "Customer_ID string, snapshot_date date, fe_1 int, event_id long"


def later(day, months):
    at = day.year * 12 + day.month - 1 + months
    first, after = dt.date(at // 12, at % 12 + 1, 1), dt.date((at + 1) // 12, (at + 1) % 12 + 1, 1)
    return first + dt.timedelta(min(day.day, (after - first).days) - 1)


def panel_of(rows):
    first = {}
    for customer, day, value, place in rows:
        if day is not None and later(START, -6) <= day <= later(END, -1):
            old = first.get((customer, day))
            if old is None or place is not None and (old[0] is None or place < old[0]):
                first[customer, day] = place, value if place is not None else None
    panel = {}
    for (customer, day), (_, value) in first.items():
        for i in range(1, 7):
            if START <= (at := later(day, i)) <= END:
                panel.setdefault((customer, at), [None] * 6)[i - 1] = value
    return {(*k, *v) for k, v in panel.items()}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    months = [later(dt.date(1999, 1, 1), i) for i in range(36)]
    return [(draw.choice([*"abcdefgh", None]), draw.choice([*months, None]), draw.choice([None, *range(50)]),
             n if draw.random() < 0.9 else None) for n in range(900)]


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_same_rows_as_plain_python(spark, rows, hot_rows):
    clicks = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(gold.engagement_panel(clicks, START, END, "event_id", hot_rows)) == panel_of(rows)


@pytest.mark.parametrize("days", [[1, 2, 15, 27], [31], [5, 30]])
def test_days_within_a_month(spark, days):
    draw = random.Random(4)
    months = [later(dt.date(1999, 1, 1), i) for i in range(36)]
    rows = [(draw.choice("abc"), later(m.replace(day=1), 0) + dt.timedelta(days=draw.choice(days) - 1), n, n)
            for n, m in enumerate(draw.choices(months, k=150))]
    rows = [r for r in rows if r[1].day in days]
    assert rows_of(gold.engagement_panel(spark.createDataFrame(rows, SCHEMA), START, END, "event_id")) == panel_of(rows)


def test_days_that_meet_on_a_last_day(spark):
    rows = [("a", dt.date(2000, 1, 31), 5, 1), ("a", dt.date(1999, 12, 30), 7, 2), ("a", dt.date(2000, 1, 2), 9, 3)]
    clicks = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(gold.engagement_panel(clicks, START, END, "event_id")) == panel_of(rows)


def test_nothing_aggregates_the_sixfold_rows(spark, rows):
    panel = gold.engagement_panel(spark.createDataFrame(rows, SCHEMA), START, END, "event_id")
    lines = panel._jdf.queryExecution().executedPlan().toString().split("\n")
    made = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert not [line for line in lines[:made] if "Aggregate" in line or "Exchange" in line]
    assert sum("Exchange hashpartitioning(Customer_ID" in line for line in lines) <= 3  # the rows, and hot customers reduced before
