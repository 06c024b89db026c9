"""The whole cycle from raw CSV files to a retrain decision, on data derived from the test tables."""

import datetime as dt
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import job
from tidemark.sources import claims, files, tables
from tidemark.sources.schemas import MODEL_FEATURES, RAW_FILES
from tidemark.workload import standins

START, END, TRAIN = "1998-01-01", "2000-12-31", "2000-09-01"


@pytest.fixture(scope="module")
def mart(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("mart")
    raw = {"loans": standins.raw_loans, "clickstream": standins.raw_clicks,
           "attributes": standins.raw_attributes, "financials": standins.raw_financials}
    for source, build in raw.items():
        rows = build(spark, folder)
        if source == "loans":  # monthly snapshots
            rows = rows.withColumn("snapshot_date", F.trunc(F.col("snapshot_date").cast("date"), "MM").cast("string"))
        rows.write.option("header", True).csv(f"{base}/raw/{RAW_FILES[source]}")
    job.main(["bronze", "--root", f"{base}/mart", "--raw", f"{base}/raw", "--start", "1990-01-01", "--end", END])
    store = job.Store(spark, f"{base}/mart")
    job.run_silver(store, "1990-01-01", END)
    job.run_gold(store, START, END)
    return store


def test_gold_tables(mart):
    labels, risk, clicks = (mart.read(f"gold/{t}") for t in ("labels", "risk", "engagement"))
    assert set(labels.columns) == {"loan_id", "Customer_ID", "label", "label_def", "snapshot_date"}
    assert [c for c in risk.columns if c not in ("Customer_ID", "snapshot_date")] == MODEL_FEATURES
    assert dict(risk.dtypes)["snapshot_date"] == "date"
    assert clicks.columns[:-1] == ["Customer_ID", *[f"click_{i}m" for i in range(1, 7)]]
    for df in (labels, risk, clicks):
        assert df.count() > 0
        assert df.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()[0] >= dt.date(1998, 1, 1)


def test_gates_and_missing_snapshots(spark, mart, capsys):
    def said(*args):
        job.main([*args[:1], "--root", mart.root, "--start", *args[1:]])
        return capsys.readouterr().out

    assert "no quarter month" in said("train", "2000-10-01") and "fewer than 20" in said("train", "1998-03-01")
    assert "no model" in said("score", "2000-10-01")
    assert job.why_not(mart, "train", TRAIN) is None
    job.mark_run(job.Store(spark, f"{mart.root}/other"), "score", TRAIN)
    assert not (spark.read.parquet(f"{mart.root}/other/runs").filter("step = 'train'").count())
    held = [r[0] for r in mart.read("gold/labels").select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    assert job.missing_spans(mart, ["gold/labels"], str(held[0]), str(held[-1])) == []
    later = [("2001-01-01", "2001-03-01")]
    assert job.missing_spans(mart, ["gold/labels", "gold/risk"], str(held[0]), "2001-03-01")[-1:] == later
    assert job.missing_spans(mart, ["nowhere"], "2001-01-01", "2001-03-01") == later


def test_a_step_leaves_no_scratch(spark, mart, capsys, tmp_path):
    from tidemark import session

    with session.scratch_scope(spark) as folder:
        at = session.scratch_path(spark, "x")
        assert at.startswith(folder) and session.write_and_reread(spark.range(3), "y").count() == 3
        assert files.names(spark, folder)
    assert not files.exists(spark, folder) and not session.scratch_path(spark, "x").startswith(folder)
    before = {n for n, _ in files.names(spark, f"{session.shared_folder(spark)}/tidemark")}
    job.main(["gold", "--root", f"{mart.root}/none", "--start", "2000-01-01"])
    assert {n for n, _ in files.names(spark, f"{session.shared_folder(spark)}/tidemark")} == before


def test_layers_without_any_source(spark, tmp_path):
    store = job.Store(spark, str(tmp_path / "empty"))
    job.run_gold(store, "2000-01-01", "2000-02-01")
    job.run_silver(store, "2000-01-01", "2000-02-01")
    job.run_gold(store, "2000-01-01", "2000-02-01")
    assert store.read("gold/labels", schema=job.LABEL_SCHEMA).count() == 0
    assert job.why_not(store, "train", TRAIN).endswith(": 0") and job.why_not(store, "score", TRAIN).startswith("no model")


def test_cycle(spark, mart):
    space = {"maxIter": [2, 3], "maxDepth": [2], "stepSize": [0.1, 1.0]}
    with pytest.raises(ValueError):
        job.run_scoring(mart, "2000-10-01")
    assert job.run_training(mart, TRAIN, draws=2, space=space) == "credit_model_1"
    assert job.run_scoring(mart, "2000-10-01") == "credit_model_1"
    assert job.why_not(mart, "train", TRAIN) == "this date was trained before"
    assert job.why_not(mart, "score", "2000-10-01") is None and job.why_not(mart, "score", "2000-10-01", 999)
    decisions = job.run_monitoring(mart, "2000-10-01")
    assert decisions["drift"] in ("pass", "retrain") and decisions["performance"] in ("done", "retrain")

    job.run_drift(mart, "2000-09-01", "2000-12-01", 3)
    spans = {str(r["last"]): r for r in mart.read("gold/span_drift").collect()}
    assert sorted(spans) == ["2000-10-31", "2000-11-30", "2000-12-31"]  # the spans that hold the scored snapshot
    record = job.tables.read_drift(spark, mart.path("gold/drift"), snapshot="2000-10-01").first()
    for r in spans.values():
        assert (r["psi_score"], r["csi_max"]) == pytest.approx((record["psi_score"], record["csi_max"]))

    predictions = mart.read("gold/predictions")
    cohort = mart.read("gold/labels", "2000-10-01", "2000-10-01")
    assert predictions.select("Customer_ID").distinct().count() == cohort.select("Customer_ID").distinct().count()
    low, high = predictions.agg(F.min("model_predictions"), F.max("model_predictions")).first()
    assert 0 <= low <= high <= 1
    baseline = spark.read.parquet(mart.path("baseline"))
    assert baseline.count() == 12
    assert {r[0] for r in baseline.select(F.round(F.aggregate("expected", F.lit(0.0), lambda a, x: a + x), 9)).collect()} == {1.0}
    logged = {r.metric for r in spark.read.parquet(mart.path("gold/metrics")).select("metric").distinct().collect()}
    assert {"auc_train", "auc_test", "auc_oot", "gini_oot", "psi_score_oot", "csi_max_test", "cv_balanced_accuracy",
            "ml_psi_score", "ml_score_mean", "ml_auc", "ml_auc_threshold", "parameter_maxIter"} <= logged


SPACE = {"maxIter": [2], "maxDepth": [2]}


def test_of_two_runs_one_trains(spark, mart):
    known = tables.list_files(spark, mart.path("models"), "part-*").count() if files.exists(spark, mart.path("models")) else 0
    ended, start = [], threading.Barrier(2)

    def train():
        start.wait()
        try:
            ended.append(job.run_training(mart, "2000-06-01", draws=1, space=SPACE))
        except claims.Taken:
            ended.append(None)

    threads = [threading.Thread(target=train) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    model_id, = [m for m in ended if m]
    assert None in ended and len(ended) == 2
    assert job.current_model(mart) == model_id
    trained = claims.records(spark, mart.path("registry"), job.REGISTRY_SCHEMA).filter("train_date = '2000-06-01'").collect()
    assert [f"{r['name']}_{r['version']}" for r in trained] == [model_id]
    assert tables.list_files(spark, mart.path("models"), "part-*").count() > known
    assert job.why_not(mart, "train", "2000-06-01") == "this date was trained before"
    with pytest.raises(claims.Taken):
        job.run_training(mart, "2000-06-01", draws=1, space=SPACE)


def test_a_run_that_fails_gives_its_claim_back(spark, mart, monkeypatch):
    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(job.scoring, "search", broken)
        job.run_training(mart, "2000-03-01", draws=1, space=SPACE)
    folder = mart.path("claims/train=2000-03-01")
    assert claims.state(spark, folder) == "failed"
    # A run whose lease is over is overtaken, and does not make its model known when it comes back.
    dead = claims.take(spark, folder)
    assert claims.state(spark, folder) == "held" and job.why_not(mart, "train", "2000-03-01", 1) == "another run trains this date"
    with pytest.raises(claims.Taken):
        claims.take(spark, folder)
    heir = claims.take(spark, folder, lease_hours=-1)
    assert (dead.attempt, heir.attempt) == (2, 3)
    assert not claims.is_mine(spark, dead) and claims.is_mine(spark, heir)
    with pytest.raises(claims.Taken):
        job._train(mart, "2000-03-01", 1, SPACE, job.MODEL, dead)
    assert claims.records(spark, mart.path("registry"), job.REGISTRY_SCHEMA).filter("train_date = '2000-03-01'").count() == 0
    claims.finish(spark, heir)
    assert claims.state(spark, folder) == "done"
    assert claims.take(spark, folder, again=True).attempt == 4


def test_numbers_are_taken_once(spark, tmp_path):
    folder, got = f"file://{tmp_path}/n", []
    threads = [threading.Thread(target=lambda: got.append(claims.reserve(spark, folder))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and claims.reserve(spark, folder, after=10) == 11
    assert claims.compare_and_set(spark, f"{folder}/r", 1, {"name": "a"})
    assert not claims.compare_and_set(spark, f"{folder}/r", 1, {"name": "b"})
    assert [r["name"] for r in claims.records(spark, f"{folder}/r", "name string").collect()] == ["a"]


class Unregistered(job.Store):
    """The same mart without registry and without the table of baselines."""

    def path(self, name):
        return super().path(f"nowhere/{name}" if name.startswith(("registry", "baseline")) else name)


def test_stores_laid_out_by_customer(spark, mart):
    from tidemark.plans import dataset

    assert job.laid_out(mart) is None
    assert job.run_layout(mart) == "layouts/00000001"
    stores = job.laid_out(mart)
    labels, risk = mart.read("gold/labels"), mart.read("gold/risk")
    for placed, moved in ((dataset.training_set_in_place(stores, TRAIN), dataset.training_set(labels, risk, TRAIN)),
                          (dataset.scoring_cohort_in_place(stores, "2000-11-01"), dataset.scoring_cohort(labels, risk, "2000-11-01"))):
        assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
        assert sorted(placed.columns) == sorted(moved.columns) and moved.count() > 0
        assert Counter(map(tuple, placed.select(*moved.columns).collect())) == Counter(map(tuple, moved.collect()))
    job.run_gold(mart, END[:8] + "01", END)  # one month is written again: the layout is older than the stores
    assert job.laid_out(mart) is None and job.run_layout(mart) == "layouts/00000002" and job.laid_out(mart) is not None


def test_the_newest_model_file_scores_without_a_registry(spark, mart):
    store = Unregistered(spark, mart.root)
    found = job.resolved_model(store).first()
    assert (found["source"], found["model_id"]) == ("file", job.resolved_model(store).first()["model_id"])
    newest = max(n for n, _ in files.names(spark, mart.path("models")))
    assert found["model_id"] == newest
    assert job.why_not(store, "score", "2000-11-01") is None
    assert job.run_scoring(store, "2000-11-01") == newest
    drift = tables.read_drift(spark, store.path("gold/drift"), snapshot="2000-11-01").first()
    assert drift["model_id"] == newest and drift["psi_score"] is not None  # bins came from the file beside the model
    table = mart.read("baseline").filter(F.col("model_id") == newest).drop("model_id")
    assert sorted(map(tuple, job.stored_baseline(store, newest).select(*table.columns).collect())) == sorted(map(tuple, table.collect()))
    assert job.current_model(Unregistered(spark, f"{mart.root}/none")) is None
