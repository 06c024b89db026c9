"""Readers and writers."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.functions.dates import month_calendar
from tidemark.operators import decisions
from tidemark.plans import bronze, monitoring
from tidemark.sources import sinks, tables


def test_csv_columns_by_name_and_as_text(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "features_attributes.csv").write_text(
        "extra,Customer_ID,Age,snapshot_date\nx,007,1.50E8,2023-01-01\ny,008,,2023-02-01\nz,009,5,broken\n")
    out = str(tmp_path / "bronze")
    bronze.ingest(spark, str(raw), "attributes", out)
    rows = tables.read_snapshots(spark, out).orderBy("Customer_ID").collect()
    assert [(r.Customer_ID, r.Age, r.snapshot_date) for r in rows] == [
        ("007", "1.50E8", dt.date(2023, 1, 1)), ("008", None, dt.date(2023, 2, 1))]
    bronze.ingest(spark, str(raw), "attributes", out, "2023-02-01")
    assert tables.read_snapshots(spark, out).count() == 2


def test_rewriting_a_snapshot_leaves_the_others(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.range(10).select("id", F.expr("date'2023-01-01' + make_ym_interval(0, int(id % 3))").cast("date").alias("snapshot_date"))
    sinks.write_snapshots(df, out)
    sinks.write_snapshots(df.filter("snapshot_date = '2023-02-01'").withColumn("id", F.lit(-1).cast("long")), out)
    got = {str(r[0]): (r[1], r[2]) for r in tables.read_snapshots(spark, out).groupBy("snapshot_date").agg(
        F.count("*"), F.min("id")).collect()}
    assert got == {"2023-01-01": (4, 0), "2023-02-01": (3, -1), "2023-03-01": (3, 2)}
    pruned = tables.read_snapshots(spark, out, "2023-02-01", "2023-02-01")
    assert "PartitionFilters: [isnotnull(snapshot_date" in pruned._jdf.queryExecution().toString()
    assert pruned.count() == 3
    missing = decisions.missing_snapshots(month_calendar(spark, "2022-12-01", "2023-03-01"), tables.read_snapshots(spark, out))
    assert [str(r[0]) for r in missing.collect()] == ["2022-12-01"]


def test_missing_table_is_empty(spark, tmp_path):
    df = tables.read_or_empty(spark, str(tmp_path / "nothing"), "Customer_ID string, snapshot_date date")
    assert df.count() == 0 and df.columns == ["Customer_ID", "snapshot_date"]


def test_drift_records_round_trip(spark, tmp_path):
    scores = spark.createDataFrame(
        [("2024-01-01", "m1", 0.3, None), ("2024-02-01", "m1", None, 0.1)],
        "snapshot_date string, model_id string, psi_score double, csi_max double")
    out = str(tmp_path / "drift")
    sinks.write_drift(decisions.drift_flags(scores), out)
    rows = {r.snapshot_date: r for r in tables.read_drift(spark, out).collect()}
    assert rows["2024-01-01"].psi_breach and not rows["2024-01-01"].csi_breach and rows["2024-01-01"].csi_max is None
    assert not rows["2024-02-01"].psi_breach and rows["2024-02-01"].psi_threshold == 0.25
    line = next((tmp_path / "drift").rglob("*.json")).read_text().splitlines()[0]
    assert list(json.loads(line)) == ["snapshot_date", "model_id", "psi_score", "csi_max", "psi_breach", "csi_breach",
                                      "psi_threshold", "csi_threshold"]


def test_baseline_json(spark, tmp_path):
    (tmp_path / "psi_bins.json").write_text(json.dumps({
        "feature_cols": ["a", "b"], "numeric_cols": ["a"], "score_bins": [0.0, 0.5, 1.0], "score_expected": [0.4, 0.6],
        "feature_bins": {"a": [1.0, 2.0]}, "feature_expected": {"a": [1.0]}}, indent=1))
    rows = {r.feature: (r.metric_kind, r.edges, r.expected) for r in tables.read_baseline_json(spark, str(tmp_path)).collect()}
    assert rows == {"score": ("score", [0.0, 0.5, 1.0], [0.4, 0.6]), "a": ("feature", [1.0, 2.0], [1.0])}


def test_file_catalogue(spark, tmp_path):
    for name in ("gold_label_store_2024_01_01.parquet", "gold_label_store_2024_02_01.parquet", "other.parquet"):
        (tmp_path / name).write_bytes(b"x")
    files = tables.list_files(spark, str(tmp_path), "*.parquet")
    dated = files.select(tables.snapshot_in_name(F.col("path"), "gold_label_store").alias("d")).orderBy("d")
    assert [r.d for r in dated.collect()] == [None, dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_metrics_last_wins(spark, tmp_path):
    records = spark.createDataFrame(
        [("2024-01-01", "m", 0.1, None)], "snapshot_date string, model_id string, psi_score double, csi_max double")
    out = str(tmp_path / "metrics")
    for day, shift in (("2024-01-02", 0.0), ("2024-01-03", 0.4)):
        flags = decisions.drift_flags(records.withColumn("psi_score", F.col("psi_score") + shift))
        sinks.append_metrics(monitoring.drift_metrics(flags, F.lit(day).cast("timestamp")), out)
    last = {r.metric: r.value for r in sinks.latest_metrics(spark.read.parquet(out)).collect()}
    assert last == {"ml_psi_score": 0.5, "ml_psi_threshold": 0.25, "ml_csi_threshold": 0.25}


def test_predictions_by_model_and_snapshot(spark, tmp_path):
    out = str(tmp_path / "pred")
    df = spark.createDataFrame([("c", 0.5, "n", "m1", dt.date(2024, 1, 1)), ("d", 0.6, "n", "m2", dt.date(2024, 1, 1))],
                               "Customer_ID string, model_predictions double, model_name string, model_id string, snapshot_date date")
    sinks.write_predictions(df, out)
    assert (tmp_path / "pred" / "model_id=m1" / "snapshot_date=2024-01-01").is_dir()
    assert spark.read.parquet(out).count() == 2


def test_drift_records_several_in_a_file(spark, tmp_path):
    lines = "\n".join('{"snapshot_date": "2024-01-01", "model_id": "00%d", "psi_score": 0.%d}' % (i, i) for i in range(1, 4))
    (tmp_path / "lines.json").write_text(lines + "\n")
    (tmp_path / "whole.json").write_text('{\n "snapshot_date": "2024-02-01",\n "model_id": "7"\n}\n')
    rows = tables.read_drift(spark, f"file://{tmp_path}/lines.json").collect()
    assert sorted(r["model_id"] for r in rows) == ["001", "002", "003"]
    row, = tables.read_drift(spark, f"file://{tmp_path}/whole.json", whole_files=True).collect()
    assert (row["snapshot_date"], row["model_id"]) == ("2024-02-01", "7")
    assert tables.read_drift(spark, f"file://{tmp_path}/none").count() == 0


def test_drift_of_one_snapshot(spark, tmp_path):
    out = f"file://{tmp_path}/drift"
    scores = spark.createDataFrame(
        [(f"2024-0{m}-01", f"00{i}", 0.1, 0.2) for m in (1, 2) for i in range(3)] + [("2024-01-01", "000", 0.3, 0.1)],
        "snapshot_date string, model_id string, psi_score double, csi_max double")
    sinks.write_drift(decisions.drift_flags(scores), out)
    assert tables.read_drift(spark, out).count() == 7
    assert tables.read_drift(spark, out, snapshot="2024-01-01").count() == 4


def test_rewriting_empties_a_snapshot(spark, tmp_path):
    out = f"file://{tmp_path}/store"
    rows = spark.createDataFrame([(i, f"2024-0{m}-01") for m in range(1, 6) for i in range(3)], "id int, day string").selectExpr(
        "id", "date(day) as snapshot_date")
    sinks.write_snapshots(rows, out, start="2024-01-01", end="2024-05-01")
    sinks.write_snapshots(rows.filter("snapshot_date = '2024-02-01'").limit(1), out, start="2024-02-01", end="2024-04-01")
    left = {str(r[0]): r[1] for r in tables.read_snapshots(spark, out).groupBy("snapshot_date").count().collect()}
    assert left == {"2024-01-01": 3, "2024-02-01": 1, "2024-05-01": 3}


def test_model_ids_stay_text(spark, tmp_path):
    out = f"file://{tmp_path}/predictions"
    rows = spark.createDataFrame([("c", "007", "2024-01-01")], "Customer_ID string, model_id string, day string").selectExpr(
        "Customer_ID", "model_id", "date(day) as snapshot_date")
    sinks.write_predictions(rows, out)
    row, = tables.read_snapshots(spark, out, "2024-01-01", "2024-01-01").collect()
    assert row["model_id"] == "007" and str(row["snapshot_date"]) == "2024-01-01"


def test_monitoring_before_any_scoring(spark, tmp_path):
    from tidemark import job

    assert job.run_monitoring(job.Store(spark, f"file://{tmp_path}/mart"), "2024-01-01") == {"drift": "pass", "performance": "pass"}


def test_split_sizes_with_keys_that_look_alike(spark):
    from tidemark.operators.stratify import stratified_split

    keys = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("a\\", "|b"), ("a\\|", "b"), ("\\N", "x"), ("", "x"), ("x", ""), (None, None)]
    df = spark.createDataFrame([(a, b, 1) for a, b in keys], "a string, b string, label int")
    found = stratified_split(df, "label", ["a", "b"], 0.7)
    assert sorted(r["split"] for r in found.collect()) == ["test"] * 3 + ["train"] * 7
