"""Stored counts per bin: additive, made once, and enough to judge any span."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import bin_state as bins
from tidemark.operators import stability
from tidemark.plans import monitoring
from tidemark.sources import tables, versions


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(4)
    rows = []
    for month in range(1, 13):
        for model in ("m1", "m2"):
            for _ in range(200):
                score = None if rng.random() < 0.03 else float("nan") if rng.random() < 0.03 else float(rng.normal(month / 8, 1))
                rows.append((f"2024-{month:02d}-01", model, score, float(rng.integers(0, 6)), None))
    return spark.createDataFrame(rows, "day string, model_id string, score double, a double, b double").select(
        F.col("day").cast("date").alias("snapshot_date"), "model_id", "score", "a", "b").cache()


@pytest.fixture(scope="module")
def baseline(scored):
    return stability.monitoring_baseline(scored.filter("snapshot_date < '2024-04-01'"), ["a", "b"]).cache()


def rows_of(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_state_is_additive_and_whole(scored, baseline):
    whole = rows_of(bins.bin_state(scored, ["score", "a", "b"], baseline), "feature", "bin")
    parts = None
    for month in (1, 2, 3):
        part = bins.bin_state(scored.filter(F.month("snapshot_date") % 3 == month % 3), ["score", "a", "b"], baseline)
        parts = part if parts is None else parts.unionByName(part)
    merged = rows_of(bins.merged(parts), "feature", "bin")
    assert {k: r["rows"] for k, r in merged.items()} == {k: r["rows"] for k, r in whole.items()}
    for feature in ("score", "a", "b"):
        assert sum(r["rows"] for (f, _), r in whole.items() if f == feature) == 4800
    missing = scored.filter("score is null or isnan(score)").count()
    assert whole["score", bins.MISSING]["rows"] == missing and whole["b", bins.MISSING]["rows"] == 4800
    assert whole["score", bins.OUTSIDE]["rows"] > 0


@pytest.mark.parametrize("by", [[], ["model_id"], ["snapshot_date", "model_id"]])
def test_index_of_state_is_that_of_the_rows(scored, baseline, by):
    state = bins.bin_state(scored, ["score", "a", "b"], baseline, ["snapshot_date", "model_id"])
    got = rows_of(bins.psi_of_state(bins.merged(state, by), baseline, by), *by, "feature")
    want = rows_of(stability.psi_against_baseline(scored, ["score", "a", "b"], baseline, by), *by, "feature")
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k]["psi"] == pytest.approx(r["psi"], abs=1e-12)


def test_spans_overlap_and_rows_are_not_read(spark, scored, baseline, tmp_path):
    root = f"file://{tmp_path}/counts"
    monthly = scored.withColumn("month", F.month("snapshot_date"))
    for month in (1, 2, 3):  # quarter by quarter
        part = monthly.filter((F.col("month") - 1) % 3 == month - 1).drop("month")
        versions.publish(monitoring.scored_state(part, ["a", "b"], baseline), root, monitoring.BY_MODEL)
    state = tables.read_snapshots(spark, root)
    found = monitoring.span_drift(state, dates.rolling_spans(spark, "2024-03-01", "2024-12-01", 3), baseline)
    assert all("/counts/" in f for f in state.inputFiles()) and "InMemoryTableScan" not in state._jdf.queryExecution().toString()
    got = rows_of(found, "last", "model_id")
    assert len(got) == 20
    import datetime as dt
    rows = scored.filter("snapshot_date between '2024-05-01' and '2024-07-31' and model_id = 'm2'")
    want = stability.psi_against_baseline(rows, ["score", "a", "b"], baseline).collect()
    r = got[dt.date(2024, 7, 31), "m2"]
    assert r["psi_score"] == pytest.approx(next(w["psi"] for w in want if w["feature"] == "score"))
    assert r["csi_max"] == pytest.approx(max(w["psi"] for w in want if w["feature"] != "score"))

    again = scored.filter("snapshot_date = '2024-06-01'").limit(100).withColumn("score", F.lit(99.0))
    versions.publish(monitoring.scored_state(again, ["a", "b"], baseline), root, monitoring.BY_MODEL)
    one = bins.merged(tables.read_snapshots(spark, root, "2024-06-01", "2024-06-01")).filter("feature = 'score'").collect()
    assert [(r["bin"], r["rows"] <= 200) for r in one if r["rows"] >= 100][0] == (bins.OUTSIDE, True)


def test_counts_over_other_edges_are_not_mixed(scored, baseline):
    state = bins.bin_state(scored, ["score", "a"], baseline, ["model_id"])
    other = baseline.withColumn("edges", F.when(F.col("feature") == "score", F.expr("transform(edges, e -> e + 1)")).otherwise(F.col("edges")))
    assert {r["feature"] for r in bins.psi_of_state(state, other, ["model_id"]).collect()} == {"a"}
    assert {tuple(r) for r in bins.stale(state, other, ["model_id"]).collect()} == {("m1", "score"), ("m2", "score")}
    assert bins.stale(state, baseline, ["model_id"]).count() == 0


def test_a_baseline_from_counts(scored, baseline):
    later = scored.filter("snapshot_date >= '2024-09-01'")
    state = bins.bin_state(later, ["score", "a", "b"], baseline)
    new = rows_of(bins.baseline_of_state(state, baseline), "feature")
    assert new["b",]["expected"] == [1.0] and sum(new["score",]["expected"]) == pytest.approx(1)
    zero = bins.psi_of_state(state, bins.baseline_of_state(state, baseline)).collect()
    assert all(r["psi"] == pytest.approx(0) for r in zero)


def test_state_of_no_rows(scored, baseline):
    state = bins.bin_state(scored.limit(0), ["score", "a"], baseline, ["snapshot_date", "model_id"])
    assert state.count() == 0 and bins.psi_of_state(state, baseline, ["model_id"]).count() == 0
