"""The skew-safe left join gives plain left-join results."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import Colocated, deal_left, hot_keys, left_join


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), F.col("id").alias("l"))
    right = spark.range(200).select(
        F.when(F.col("id") < 70, "hot").when(F.col("id") % 60 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 30)).alias("k"),
        (F.col("id") % 5).alias("r"))  # many identical copies of the hot key
    return left, right


def test_same_rows_as_a_plain_join(sides):
    left, right = sides
    want = Counter(map(tuple, left.join(right, "k", "left").collect()))
    assert Counter(map(tuple, left_join(left, right, "k").collect())) == want


def test_nothing_but_the_key(spark, sides):
    left, right = sides
    only = right.select("k")
    want = Counter(map(tuple, left.join(only, "k", "left").collect()))
    assert Counter(map(tuple, left_join(left, only, "k").collect())) == want


@pytest.mark.parametrize("hot_rows", [1, 7, 30, 65, 1000])
def test_cut_keys_on_either_side(sides, hot_rows):
    left, right = sides
    for a, b in ((left, right), (right.withColumnRenamed("r", "l"), left.withColumnRenamed("l", "r"))):
        want = Counter(map(tuple, a.join(b, "k", "left").collect()))
        assert Counter(map(tuple, left_join(a, b, "k", hot_rows).collect())) == want


def test_columns_of_any_name(spark):
    left = spark.createDataFrame([("x", 1, 2), ("x", 7, 8), ("y", 3, 4)], "k string, a int, b int")
    right = spark.createDataFrame([("x", 5, 6), ("x", 5, 9)], "k string, n int, parts int")
    got = left_join(left, right, "k", 1)
    assert got.columns == ["k", "a", "b", "n", "parts"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k", "left").collect()))


def test_a_cut_key_is_spread(spark, sides):
    left, right = sides
    hot = hot_keys(left, right, "k", 20)
    assert {r["k"]: (r["a"], r["b"]) for r in hot.collect()}["hot"] == (5, 4)
    cells = deal_left(left, hot, "k").filter("k = 'hot'").groupBy("__slot").count().collect()
    assert len(cells) == 20 and max(r["count"] for r in cells) < 60
    plan = left_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "LeftAnti" not in plan


def test_each_side_is_read_once_by_the_join(spark, sides, tmp_path):
    for name, df in zip(("l", "r"), sides):
        df.write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("l", "r"))
    plan = left_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count(f"{tmp_path}/l]") <= 1


@pytest.mark.parametrize("hot_rows", [10, 1000])
def test_stores_join_in_place(spark, sides, tmp_path, hot_rows):
    left, right = sides
    root = f"file://{tmp_path}/stores"
    stores = Colocated(spark, root).lay_out(left.filter("l < 200"), right.filter("r <> 3"), "k", hot_rows)
    stores.add(left.filter("l >= 200"), "left")
    stores.add(right.filter("r = 3"), "right")
    want = Counter(map(tuple, left.join(right, "k", "left").collect()))
    joined = stores.join()
    assert Counter(map(tuple, joined.collect())) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.split("== Initial Plan ==")[-1].count("Bucketed: true") == 2
    some = stores.join("l % 2 = 0", [])
    assert Counter(map(tuple, some.collect())) == Counter(map(tuple, left.filter("l % 2 = 0").join(right.select("k"), "k", "left").collect()))
    # Another session knows nothing of the tables but the folder.
    for side in ("left", "right"):
        spark.sql(f"drop table {stores._table(side)}")
    again = Colocated(spark, root).join()
    assert Counter(map(tuple, again.collect())) == want
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
