"""Decisions, gates and the published drift values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import month_calendar
from tidemark.operators import decisions
from tidemark.plans import monitoring

# Model number, snapshot, score PSI, largest feature CSI.
PUBLISHED = """
2 2024-09-01 0.034289 0.039169
2 2024-10-01 0.026894 0.035485
2 2024-11-01 0.026851 0.037365
2 2024-12-01 0.025502 0.038026
4 2023-07-01 0.017313 0.033254
4 2023-10-01 0.011668 0.042456
4 2024-02-01 0.009187 0.061425
4 2024-09-01 0.034289 0.039169
6 2024-08-01 0.019539 0.034617
9 2024-09-01 0.016572 0.041895
10 2024-12-01 0.025502 0.038026
"""


def records(spark, rows):
    schema = ("snapshot_date date, model_id string, psi_score double, csi_max double, psi_threshold double, "
              "csi_threshold double, written_at timestamp")
    return spark.createDataFrame(
        [(dt.date.fromisoformat(r[0]), *r[1:6], dt.datetime.fromisoformat(r[6])) for r in rows], schema)


def test_published_records_pass(spark):
    lines = [line.split() for line in PUBLISHED.split("\n") if line]
    df = records(spark, [(d, f"model_{m}", float(p), float(c), 0.25, 0.25, "2025-01-01") for m, d, p, c in lines])
    runs = month_calendar(spark, "2023-01-01", "2024-12-01")
    out = decisions.drift_decision(df, runs).collect()
    assert len(out) == 24 and {r.decision for r in out} == {"pass"}
    newest = {str(r.snapshot_date): r.model_id for r in out}
    assert newest["2024-09-01"] == "model_9" and newest["2023-01-01"] is None


@pytest.mark.parametrize("psi, csi, psi_limit, decision", [
    (0.25, 0.1, 0.25, "retrain"), (0.2499, 0.1, 0.25, "pass"), (None, 0.1, 0.25, "pass"), (None, 0.25, 0.25, "retrain"),
    (None, None, None, "pass"), (0.25, None, None, "retrain"), (0.2, None, 0.1, "retrain"),
])
def test_drift_decision(spark, psi, csi, psi_limit, decision):
    df = records(spark, [("2024-01-01", "new", psi, csi, psi_limit, None, "2024-02-01"),
                         ("2024-01-01", "old", 9.0, 9.0, 0.25, 0.25, "2024-01-01")])
    out = decisions.drift_decision(df, df.select("snapshot_date").distinct()).first()
    assert (out.model_id, out.decision) == ("new", decision)


@pytest.mark.parametrize("auc, gini, flags", [
    (0.69, 0.38, (True, False, True)), (0.70, 0.40, (False, False, False)), (0.64, 0.28, (True, True, True)),
    (None, None, (False, False, False))])
def test_performance_flags(spark, auc, gini, flags):
    r = decisions.performance_flags(spark.createDataFrame([(auc, gini)], "auc double, gini double")).first()
    assert (r.auc_breach, r.gini_breach, r.breach) == flags


def history(spark, end):
    return month_calendar(spark, "2023-01-01", end)


@pytest.mark.parametrize("run, months_end, n, train", [
    ("2024-09-01", "2024-09-01", 21, True), ("2024-08-01", "2024-08-01", 20, False), ("2024-06-01", "2024-06-01", 18, False),
    ("2024-09-01", "2024-07-01", 19, False), ("2024-09-01", "2024-12-01", 21, True)])
def test_training_gate(spark, run, months_end, n, train):
    runs = spark.createDataFrame([(dt.date.fromisoformat(run),)], "run_date date")
    r = decisions.training_gate(runs, history(spark, months_end)).first()
    assert (r.n_months, r.train) == (n, train)


@pytest.mark.parametrize("run, model, infer", [
    ("2024-08-01", "m", False), ("2024-09-01", "m", True), ("2024-09-01", None, False)])
def test_inference_gate(spark, run, model, infer):
    runs = spark.createDataFrame([(dt.date.fromisoformat(run),)], "run_date date")
    models = spark.createDataFrame([(model,)], "model string")
    assert decisions.inference_gate(runs, history(spark, "2024-12-01"), models).first().infer is infer
    assert not decisions.inference_gate(runs, history(spark, "2024-12-01"), models.limit(0)).first().infer


def test_no_history_no_training(spark):
    runs = spark.createDataFrame([(dt.date(2024, 9, 1),)], "run_date date")
    r = decisions.training_gate(runs, history(spark, "2024-12-01").limit(0)).first()
    assert (r.n_months, r.train) == (0, False)


def test_resolve_model(spark):
    registry = spark.createDataFrame(
        [("risk", 9, dt.datetime(2024, 1, 1)), ("risk", 10, dt.datetime(2024, 2, 1)), ("other", 11, dt.datetime(2024, 3, 1))],
        "name string, version int, last_updated timestamp")
    files = spark.createDataFrame(
        [("a.pkl", dt.datetime(2023, 1, 1)), ("b.pkl", dt.datetime(2023, 2, 1))], "file string, modified timestamp")

    def model(name, as_of=None):
        at = None if as_of is None else F.lit(as_of).cast("timestamp")
        return tuple(decisions.resolve_model(registry, files, name, at).first())

    assert model("risk") == ("models:/risk/10", "risk_10", "registry")
    assert model("risk", "2024-01-15") == ("models:/risk/9", "risk_9", "registry")
    assert model("none") == ("b.pkl", "b", "file")
    assert model("none", "2022-01-01") == (None, None, None)


def test_markers(spark):
    runs = spark.createDataFrame([(1,), (2,)], "run_date int")
    assert [r[0] for r in decisions.not_yet_run(runs, spark.createDataFrame([(1,)], "run_date int")).collect()] == [2]


def test_any_known(spark):
    df = spark.createDataFrame([(None,), (1,)], "v int")
    assert decisions.any_known(df, "v").first().found is True
    assert decisions.any_known(df.filter("v is null"), "v").first().found is False


def test_performance_of_newest_predictions(spark):
    day = dt.date(2024, 1, 1)
    pred = spark.createDataFrame(
        [("a", day, "m1", 0.9, 1), ("b", day, "m1", 0.1, 1), ("a", day, "m2", 0.2, 2), ("b", day, "m2", 0.7, 2),
         ("c", day, "m2", None, 2), ("d", day, "m2", 0.3, 2)],
        "Customer_ID string, snapshot_date date, model_id string, model_predictions double, written_at int")
    labels = spark.createDataFrame([("a", day, 1), ("b", day, 0), ("c", day, 1)], "Customer_ID string, snapshot_date date, label int")
    r = monitoring.performance_records(pred, labels).collect()
    assert len(r) == 1 and (r[0].model_id, r[0].auc, r[0].breach, r[0].decision) == ("m2", 0.0, True, "retrain")


def test_records_as_json(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "m", 0.5, None)], "snapshot_date date, model_id string, auc double, gini double")
    assert monitoring.record_json(df, ["auc", "gini"]).first().record == '{"auc":0.5,"gini":null}'
