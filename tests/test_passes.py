"""How often rows are read and what is held while they are."""

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import quantiles, sketches


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_row_is_sketched_once_for_all_columns(spark):
    rows = spark.createDataFrame([("a", 1.0, None), ("a", float("nan"), None), ("b", 2.0, 3.0), (None, -1.0, 4.0)], "g string, x double, y double")
    made = sketches.quantile_sketches(rows, ["x", "y"], ["g"])
    assert "Expand" not in plan_of(made)
    found = {(r["g"], r["feature"]): (r["n"], list(r["quantiles"])) for r in sketches.sketch_quantiles(made, [0.0, 1.0]).collect()}
    assert found == {("a", "x"): (1, [1.0, 1.0]), ("b", "x"): (1, [2.0, 2.0]), ("b", "y"): (1, [3.0, 3.0]),
                     (None, "x"): (1, [-1.0, -1.0]), (None, "y"): (1, [4.0, 4.0])}


def test_quantiles_are_exact_over_many_more_rows_than_a_sketch_holds(spark):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("x"), (F.col("id") % 3).alias("y"))
    found = {r["feature"]: list(r["quantiles"]) for r in quantiles.exact_quantiles(
        rows, ["x", "y"], [0.0, 0.25, 0.97, 1.0], method="disc", accuracy=50).collect()}
    assert found == {"x": [0.0, 9999.0, 38799.0, 39999.0], "y": [0.0, 0.0, 2.0, 2.0]}


def test_a_text_is_stripped_once(spark):
    raw = spark.createDataFrame([("_12.5-",), ("-",), ("",), (None,)], "t string")
    out = raw.select(text.decimal_text(F.col("t")).alias("d"), text.integer_text(F.col("t")).alias("i"),
                     text.history_months(F.col("t")).alias("h"))
    assert [tuple(r) for r in out.collect()] == [(12.5, 125, None), *[(None, None, None)] * 3]
    plan = out.select("d")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
