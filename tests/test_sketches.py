"""Quantile sketches against NumPy ranks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import sketches
from tidemark.operators.quantiles import cap_at_quantile
from tidemark.sources import tables, versions

PROBS = [0.0, 0.1, 0.5, 0.9, 0.97, 1.0]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(9)
    n = 60_000
    month = np.where(rng.random(n) < 0.5, 1, rng.integers(1, 7, n))  # one month with half of the rows
    values = {"spread": rng.normal(0, 1, n), "heavy": np.exp(rng.normal(0, 6, n)), "ties": np.floor(rng.exponential(2, n))}
    values["spread"][::97] = np.nan
    rows = list(zip(month.tolist(), *[v.tolist() for v in values.values()]))
    return spark.createDataFrame(rows, "m int, spread double, heavy double, ties double").select(
        F.make_date(F.lit(2024), "m", F.lit(1)).alias("snapshot_date"), "spread", "heavy", "ties").repartition(7).cache()


def off(values, quantile, prob):
    """How far the ranks of a value lie from the one wanted, as a share."""
    low, high = np.mean(values < quantile), np.mean(values <= quantile)
    return max(0.0, low - prob, prob - high)


def test_merged_spans_keep_ranks(spark, wide, tmp_path):
    root = f"file://{tmp_path}/s"
    for m in range(1, 7):  # month by month, as scoring goes
        versions.publish(sketches.quantile_sketches(
            wide.filter(F.month("snapshot_date") == m), ["spread", "heavy", "ties"], ["snapshot_date"]), root)
    held = tables.read_snapshots(spark, root)
    spans = dates.rolling_spans(spark, "2024-03-01", "2024-06-01", 3)
    found = sketches.sketch_quantiles(sketches.over_spans(held, spans), PROBS).collect()
    assert len(found) == 12
    pdf = wide.toPandas()
    for r in found:
        part = pdf[(pdf.snapshot_date >= r["first"]) & (pdf.snapshot_date <= r["last"])][r["feature"]].dropna().to_numpy()
        assert r["n"] == len(part)
        for prob, q in zip(PROBS, r["quantiles"]):
            assert q in part and off(part, q, prob) <= 0.01
    size = held.agg(F.max(F.length("sketch"))).first()[0]
    assert size < 60_000


def test_ranks_against_numpy(wide):
    held = sketches.quantile_sketches(wide, ["heavy"])
    values = wide.toPandas().heavy.to_numpy()
    assert sketches.sketch_rank(held, 1.0).first()["rank"] == pytest.approx(np.mean(values <= 1.0), abs=0.01)
    caps = sketches.sketch_quantiles(sketches.quantile_sketches(wide, ["heavy"]), [0.97])
    told = sketches.ranks_of(wide, ["heavy"], caps).first()
    assert told["n"] == len(values) and abs(told["high"] - 0.97 * len(values)) <= 0.01 * len(values)
    assert told["high"] - told["low"] == (values == caps.first()["quantiles"][0]).sum()


def test_few_values_are_exact(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("b", None), ("c", float("nan")), ("d", 3.0)], "g string, x double")
    found = {r["g"]: r for r in sketches.sketch_quantiles(sketches.quantile_sketches(df, ["x"], ["g"]), [0.5, 0.97]).collect()}
    assert set(found) == {"a", "d"}
    assert found["a"]["quantiles"] == [49.0, 96.0] and found["d"]["quantiles"] == [3.0, 3.0]
    assert sketches.sketch_quantiles(sketches.quantile_sketches(df.limit(0), ["x"], ["g"]), [0.5]).count() == 0


def test_caps_from_stored_sketches_and_exact_ones(spark, wide):
    names = ["spread", "heavy", "ties"]
    held = sketches.quantile_sketches(wide, [*names], ["snapshot_date"])
    exact = cap_at_quantile(wide, names).groupBy("snapshot_date").agg(*[F.max(F.when(~F.isnan(c), F.col(c))).alias(c) for c in names])
    for capped in (cap_at_quantile(wide, names, approximate=True), cap_at_quantile(wide, names, sketches=held)):
        assert capped.columns == wide.columns and capped.count() == wide.count()
        top = {r["snapshot_date"]: r for r in capped.groupBy("snapshot_date").agg(
            *[F.max(F.when(~F.isnan(c), F.col(c))).alias(c) for c in names]).collect()}
        pdf = wide.toPandas()
        for r in exact.collect():
            part = pdf[pdf.snapshot_date == r["snapshot_date"]]
            for c in names:
                assert off(part[c].dropna().to_numpy(), top[r["snapshot_date"]][c], 0.97) <= 0.01
        assert dt.date(2024, 1, 1) in top
