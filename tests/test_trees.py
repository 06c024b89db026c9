"""Trees as a table of nodes give the scores of the model they come from."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import scoring, trees
from tidemark.workload import queries


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).selectExpr(
        "id", "id % 17 as a", "if(id % 7 = 0, null, id % 50) as b", "if(id % 11 = 0, double('NaN'), double(hash(id) % 13)) as c",
        "int((id % 17 > 8) != (hash(id) % 13 > 3) or id % 50 > 44) as label").cache()


@pytest.fixture(scope="module")
def saved(spark, rows, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('models')}/m"
    model = scoring.fit(rows, ["a", "b", "c"], maxIter=6, maxDepth=4, stepSize=0.3)
    model.write().save(path)
    return path, model


def test_scores_are_those_of_the_model(spark, rows, saved):
    path, model = saved
    want = {r["id"]: r["p"] for r in scoring.score(model, rows, "p").collect()}
    scored = trees.score_saved(spark, path, rows, "p")
    assert scored.columns == [*rows.columns, "p"]
    got = {r["id"]: r["p"] for r in scored.collect()}
    assert got.keys() == want.keys() and len(set(want.values())) > 10
    assert max(abs(got[i] - want[i]) for i in want) < 1e-12
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Exchange" not in plan


def test_nodes_make_whole_trees(spark, rows, saved):
    path, model = saved
    nodes = trees.node_table(spark, path)
    assert [f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in nodes.schema] == trees.NODE_SCHEMA.split(", ")
    held = nodes.collect()
    assert len({r["tree"] for r in held}) == 6 and {r["weight"] for r in held} == {1.0, 0.3}
    for tree in range(6):
        own = {r["node"]: r for r in held if r["tree"] == tree}
        children = [c for r in own.values() for c in (r["left"], r["right"]) if c is not None]
        assert sorted(children) == sorted(set(own) - {0})
        for r in own.values():
            assert (r["feature"] is None) == (r["threshold"] is None) == (r["left"] is None)
            if r["left"] is not None:
                assert own[r["left"]]["rows"] + own[r["right"]]["rows"] == r["rows"] and r["feature"] in ("__a", "__b", "__c")
        assert own[0]["rows"] == 4000
    gains = {r["feature"]: r for r in trees.feature_gains(nodes).collect()}
    assert sum(r["gain"] for r in gains.values()) == pytest.approx(1) and gains["__c"]["splits"] > 0


def test_the_model_of_the_training_query(spark, folder, tmp_path):
    """The flattened model of q_ml_scores gives Spark ML's own scores on all its rows."""
    rows = queries._model_rows(spark, folder)
    model = scoring.fit(rows.filter("split = 'train'"), queries.MODEL_FEATURES, maxIter=5, maxDepth=3)
    path = f"file://{tmp_path}/m"
    model.write().save(path)
    both = scoring.score(model, trees.score_saved(spark, path, rows, "flat"), "own")
    found = both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("flat") - F.col("own"))).alias("off"),
                     F.count_distinct("own").alias("scores")).first()
    assert found["n"] == rows.count() > 0 and found["off"] < 1e-12 and found["scores"] > 1


def test_a_single_leaf_and_missing_values(spark):
    schema = "tree int, weight double, node int, feature string, threshold double, left int, right int, value double"
    leaf = spark.createDataFrame([(0, 2.0, 0, None, None, None, None, 0.0)], schema)
    assert [r["p"] for r in trees.score(leaf, spark.range(2), "p").collect()] == [0.5, 0.5]
    split = spark.createDataFrame(
        [(0, 1.0, 0, "x", 1.0, 1, 2, 0.0), (0, 1.0, 1, None, None, None, None, -9.0), (0, 1.0, 2, None, None, None, None, 9.0)], schema)
    df = spark.createDataFrame([(1.0,), (1.1,), (None,)], "x double")
    assert [round(r["p"]) for r in trees.score(split, df, "p").collect()] == [0, 1, 1]
