"""Exact distinct counts from bitmaps, and exact frequent values from bounded candidates."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import distinct, summary
from tidemark.sources import claims


def month(m):
    return dt.date(2024, m, 1)


@pytest.fixture(scope="module")
def seen(spark):
    rnd = random.Random(6)
    rows = [(f"c{int(rnd.expovariate(1 / 9000))}", month(rnd.randrange(1, 7))) for _ in range(60_000)]
    rows += [("hot", month(m)) for m in range(1, 7) for _ in range(500)] + [(None, month(2))] * 3
    return spark.createDataFrame(rows, "customer string, snapshot_date date").repartition(6).cache()


def test_ids_are_dense_and_stay(spark, seen, tmp_path):
    store = distinct.DistinctStore(spark, f"file://{tmp_path}/d", "customer")
    store.add(seen.filter(F.month("snapshot_date") <= 3))
    first = {r["customer"]: r["id"] for r in store.ids().collect()}
    store.add(seen)
    all_ = {r["customer"]: r["id"] for r in store.ids().collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1)) and first.items() <= all_.items()
    assert sorted(all_.values()) == list(range(1, len(all_) + 1))
    assert None not in all_ and len(all_) == seen.select("customer").filter("customer is not null").distinct().count()
    assert store.bitmaps().agg(F.max("bucket")).first()[0] <= len(all_) // distinct.IDS_PER_BITMAP + 1


def test_counts_of_spans_and_so_far(spark, seen, tmp_path):
    store = distinct.DistinctStore(spark, f"file://{tmp_path}/d", "customer")
    for m in range(1, 7):
        store.add(seen.filter(F.month("snapshot_date") == m))
    store.add(seen.filter(F.month("snapshot_date") == 4))  # a snapshot once more changes nothing
    rows = [(r[0], r[1]) for r in seen.collect() if r[0] is not None]
    for r in store.over_spans(dates.rolling_spans(spark, "2024-01-01", "2024-06-01", 3)).collect():
        assert r["n_distinct"] == len({c for c, d in rows if r["first"] <= d <= r["last"]})
    known = set()
    for r in store.cumulative().orderBy("snapshot_date").collect():
        here = {c for c, d in rows if d == r["snapshot_date"]}
        assert (r["n_distinct"], r["n_new"], r["n_so_far"]) == (len(here), len(here - known), len(here | known))
        known |= here
    plan = store.cumulative()
    assert all("/bitmaps/" in f for f in plan.inputFiles())


def test_a_bucket_that_a_month_does_not_touch(spark, tmp_path):
    store = distinct.DistinctStore(spark, f"file://{tmp_path}/d", "customer")
    many = spark.range(40_000).select(F.col("id").alias("customer"), F.lit(month(1)).alias("snapshot_date"))
    store.add(many)
    store.add(spark.range(39_990, 40_010).select(F.col("id").alias("customer"), F.lit(month(2)).alias("snapshot_date")))
    got = [tuple(r) for r in store.cumulative().orderBy("snapshot_date").collect()]
    assert got == [(month(1), 40_000, 40_000, 40_000), (month(2), 20, 10, 40_010)]
    assert store.bitmaps().count() <= 4


def test_one_writer_at_a_time_and_no_rows(spark, seen, tmp_path):
    store = distinct.DistinctStore(spark, f"file://{tmp_path}/d", "customer")
    store.add(seen.limit(0))
    assert store.cumulative().count() == 0
    held = claims.take(spark, f"{store.root}/writer", again=True)
    with pytest.raises(claims.Taken):
        store.add(seen)
    claims.finish(spark, held)
    store.add(seen)
    assert store.cumulative().count() == 6


def plain_top(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0 if not isinstance(x[0], str) else x[0]))[:k]


@pytest.mark.parametrize("kind", ["skewed", "ties", "all once", "few", "text", "none"])
@pytest.mark.parametrize("tracked", [64, 4096])
def test_frequent_values(spark, kind, tracked):
    rnd = random.Random(3)
    values = {
        "skewed": [int(rnd.paretovariate(0.7)) for _ in range(30_000)] + [None] * 900,
        "ties": [i % 3000 for i in range(9000)] + list(range(40)) * 9,
        "all once": list(range(5000)),
        "few": [1, 2, 2, None],
        "text": [f"w{int(rnd.expovariate(0.02))}" for _ in range(20_000)] + [None] * 20_000,
        "none": [],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v string" if kind == "text" else "v long").repartition(5)
    got = [tuple(r) for r in summary.frequent_values(df, "v", 25, tracked).collect()]
    assert got == plain_top(values, 25)
