"""Distributed statistics against NumPy and plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import bounded, ranking, stability, stratify, summary
from tidemark.operators.quantiles import cap_at_quantile, even_probabilities, exact_quantiles

RNG = np.random.default_rng(7)
SAMPLES = {
    "spread": RNG.normal(50, 20, 5000),
    "ties": np.round(RNG.exponential(2, 5000)),
    "hot": np.concatenate([np.full(3000, 7.0), RNG.uniform(0, 10, 2000)]),
    "huge": np.exp(RNG.normal(0, 12, 5000)),
    "same": np.full(5000, 3.5),
    "two": np.where(RNG.random(5000) < 0.1, 1.0, 0.0),
}


def frame(spark, columns):
    n = len(next(iter(columns.values())))
    rows = [tuple(float(columns[c][i]) for c in columns) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(6)


@pytest.fixture(scope="module")
def wide(spark):
    return frame(spark, SAMPLES).withColumn("g", (F.xxhash64("spread") % 2).cast("int")).cache()


# A coarse sketch must not change the result.
@pytest.mark.parametrize("accuracy", [2000, 10])
def test_quantiles_equal_numpy(wide, accuracy):
    probs = even_probabilities(10)
    rows = exact_quantiles(wide, SAMPLES, probs, accuracy=accuracy).collect()
    assert {r.feature for r in rows} == set(SAMPLES)
    for r in rows:
        assert r.n == 5000
        assert r.quantiles == pytest.approx(np.quantile(SAMPLES[r.feature], np.linspace(0, 1, 11)), rel=1e-12, abs=1e-12)


def test_discrete_quantile_per_group(wide):
    pdf = wide.select("g", "ties").toPandas()
    for r in exact_quantiles(wide, ["ties"], [0.0, 0.5, 0.97, 1.0], ["g"], "disc").collect():
        v = np.sort(pdf[pdf.g == r.g].ties.to_numpy())
        want = [v[max(math.ceil(p * len(v)), 1) - 1] for p in (0.0, 0.5, 0.97, 1.0)]
        assert r.quantiles == want


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    rows = exact_quantiles(df, ["a", "b"], [0.5]).collect()
    assert [(r.feature, r.n, r.quantiles) for r in rows] == [("b", 2, [1.5])]
    assert exact_quantiles(df.limit(0), ["a", "b"], [0.5]).count() == 0


def test_cap(spark):
    df = spark.createDataFrame([(i, None) for i in range(1, 101)], "v int, empty int").withColumn("snapshot_date", F.lit("d"))
    out = cap_at_quantile(df, ["v", "empty"]).agg(F.max("v"), F.count_if(F.col("v") == 97.0), F.sum("v"), F.count("empty"))
    assert tuple(out.first()) == (97.0, 4, float(sum(range(1, 98)) + 3 * 97), 0)


def test_approximate_cap(wide):
    cap = cap_at_quantile(wide, ["spread"], 0.97, [], accuracy=1000, approximate=True).agg(F.max("spread")).first()[0]
    low, high = np.quantile(SAMPLES["spread"], [0.968, 0.972])
    assert low <= cap <= high


@pytest.fixture
def many_parts(spark):
    """Shuffles keep all their partitions, and no summary is broadcast."""
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_quantiles_over_many_parts(wide, many_parts):
    r = exact_quantiles(wide, ["spread"], [0.1, 0.5], accuracy=10).first()
    assert r.quantiles == pytest.approx(np.quantile(SAMPLES["spread"], [0.1, 0.5]))


def test_running_total(spark, many_parts):
    rows = [(g, i, int(n)) for g in ("a", "b", None) for i, n in enumerate(RNG.integers(0, 9, 200))]
    df = spark.createDataFrame(rows, "g string, i int, n long").repartition(5)
    for by, order in ((["g"], "i"), ([], "at")):
        found = bounded.running_total(df.withColumn("at", F.struct("g", "i")), by, order, "n", "upto").collect()
        seen = {}
        for r in sorted(found, key=lambda r: (r.g is not None, r.g or "", r.i)):
            key = r.g if by else 0
            seen[key] = seen.get(key, 0) + r.n
            assert r.upto == seen[key]
        assert len(found) == len(rows)
    assert bounded.running_total(df.filter("n < 0"), ["g"], "i", "n", "upto").collect() == []


def numpy_psi(base, target, bins=10, quantiles=True):
    edges = (np.unique(np.quantile(base, np.linspace(0, 1, bins + 1))) if quantiles
             else np.linspace(min(base.min(), target.min()), max(base.max(), target.max()), bins + 1))
    if len(edges) < 2 or edges[0] == edges[-1]:
        return 0.0
    sides = []
    for x in (base, target):
        c, _ = np.histogram(x, bins=edges)
        sides.append(np.clip(c / c.sum() if c.sum() else np.full(len(c), 1 / len(c)), 1e-8, 1))
    e, a = sides
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.mark.parametrize("use_quantiles", [True, False])
def test_psi_equals_numpy(wide, use_quantiles):
    pdf = wide.toPandas()
    rows = stability.psi_two_sample(wide, SAMPLES, F.col("g") == 0, use_quantiles=use_quantiles).collect()
    assert len(rows) == len(SAMPLES)
    for r in rows:
        base, target = pdf[pdf.g == 0][r.feature].to_numpy(), pdf[pdf.g != 0][r.feature].to_numpy()
        assert r.psi == pytest.approx(numpy_psi(base, target, quantiles=use_quantiles), abs=1e-12)


def test_psi_of_missing_samples(spark):
    df = spark.createDataFrame(
        [(True, 1.0, None, 5.0), (True, 2.0, None, 5.0), (False, None, 3.0, 5.0), (False, float("nan"), 4.0, 9.0)],
        "b boolean, no_target double, no_base double, constant double")
    rows = {r.feature: r.psi for r in stability.psi_two_sample(df, df.columns[1:], F.col("b")).collect()}
    assert rows == {"no_target": None, "no_base": None, "constant": 0.0}
    s = stability.csi_summary(stability.psi_two_sample(df, df.columns[1:], F.col("b"))).first()
    assert (s.csi_mean, s.csi_max) == (0.0, 0.0)


def test_histogram_drops_what_is_outside(spark):
    df = spark.createDataFrame([(float(i),) for i in range(6)], "v double")
    edges = spark.createDataFrame([("v", [1.0, 2.0, 4.0])], "feature string, edges array<double>")
    r = stability.edge_histogram(df, ["v"], edges).first()
    assert r.filled == {1: 1, 2: 3}


def test_baseline_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (1.0, None, 2.0)], "same double, empty double, score double")
    rows = {r.feature: r for r in stability.monitoring_baseline(df, ["same", "empty"]).collect()}
    assert rows["same"].edges == [1.0, 1.0] and rows["same"].expected == [1.0]
    assert rows["empty"].edges == [0.0, 1.0] and rows["empty"].expected == [1.0]
    assert rows["score"].metric_kind == "score" and sum(rows["score"].expected) == pytest.approx(1)


def test_stored_bins_with_an_empty_sample(spark):
    baseline = spark.createDataFrame(
        [("feature", "a", [0.0, 1.0, 2.0], [0.5, 0.5]), ("feature", "b", [0.0, 1.0, 2.0], [0.9, 0.1]),
         ("feature", "absent", [0.0, 1.0], [1.0])],
        "metric_kind string, feature string, edges array<double>, expected array<double>")
    df = spark.createDataFrame([(None, 99.0)], "a double, b double")
    rows = {r.feature: r.psi for r in stability.psi_against_baseline(df, ["a", "b"], baseline).collect()}
    uneven = sum((0.5 - e) * math.log(0.5 / e) for e in (0.9, 0.1))
    assert rows == {"a": pytest.approx(0.0), "b": pytest.approx(uneven)}


def test_even_histogram_equals_numpy(wide):
    rows = stability.even_histogram(wide, [c for c in SAMPLES if c != "same"], 30).collect()
    for c in SAMPLES:
        counts, edges = np.histogram(SAMPLES[c], bins=30)
        mine = sorted((r.bin, r.rows, r.bin_low) for r in rows if r.feature == c)
        if c != "same":
            assert [m[1] for m in mine] == list(counts)
            assert [m[2] for m in mine] == pytest.approx(edges[:-1])


def pair_auc(scores, labels):
    pos, neg = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc(spark):
    scores, labels = [0.1, 0.1, 0.5, 0.7, 0.9], [0, 1, 1, 0, 1]
    df = spark.createDataFrame(list(zip(scores, labels)), "s double, y int")
    assert ranking.roc_auc(df, "s", "y").first().auc == pytest.approx(0.5833333333)
    rounded = ranking.auc_and_gini(df, "s", "y", places=3).first()
    assert rounded.gini == pytest.approx(0.167)


def test_auc_equals_pairs(spark, many_parts):
    for scores in (np.round(RNG.random(300), 2), RNG.random(300), np.where(RNG.random(300) < 0.4, 0.5, RNG.random(300))):
        labels = (RNG.random(300) < scores * 0.7 + 0.1).astype(int)
        df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "s double, y int")
        assert ranking.roc_auc(df, "s", "y").first().auc == pytest.approx(pair_auc(scores, labels))


def test_auc_of_one_class(spark):
    df = spark.createDataFrame([("x", 0.5, 1), ("x", 0.6, 1), ("y", 0.1, 0), ("y", 0.2, 1)], "g string, s double, y int")
    assert {r.g: r.auc for r in ranking.roc_auc(df, "s", "y", ["g"]).collect()} == {"x": None, "y": 1.0}


def test_balanced_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0)], "y int, p double")
    assert ranking.balanced_accuracy(df, "p", "y").first().balanced_accuracy == pytest.approx(0.75)


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_split_and_folds_are_exact(spark, n):
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"))
    for label, size in df.groupBy("label").count().collect():
        split = {r[0]: r[1] for r in stratify.stratified_split(df, "label", ["id"])
                 .filter(F.col("label") == label).groupBy("split").count().collect()}
        assert split.get("train", 0) == math.floor(size * 0.8) and sum(split.values()) == size
        folds = sorted(r[1] for r in stratify.stratified_folds(df, "label", ["id"])
                       .filter(F.col("label") == label).groupBy("fold").count().collect())
        assert sum(folds) == size and folds[-1] - (folds[0] if len(folds) == 3 else 0) <= 1


def test_split_does_not_depend_on_row_order(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).cast("int").alias("label"))
    a = stratify.stratified_split(df, "label", ["id"]).orderBy("id").collect()
    b = stratify.stratified_split(df.repartition(7).orderBy(F.desc("id")), "label", ["id"]).orderBy("id").collect()
    assert a == b
    other = stratify.stratified_split(df, "label", ["id"], seed=1).orderBy("id").collect()
    assert a != other


def test_standardise_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("nan"), None)], "a double, b double")
    rows = summary.standardise(df, ["a", "b"], summary.scaling_moments(df, ["a", "b"])).collect()
    assert [r.a for r in rows][:3] == [-1.0, 1.0, None] and math.isnan(rows[3].a)
    assert [r.b for r in rows] == [0.0, 0.0, 0.0, None]


def test_score_summary(wide):
    r = summary.score_summary(wide, "spread").first()
    v = SAMPLES["spread"]
    assert r.n == len(v) and r["mean"] == pytest.approx(v.mean()) and r["std"] == pytest.approx(v.std())
    assert [r[f"p{p:02d}"] for p in summary.SCORE_PERCENTILES] == pytest.approx(np.percentile(v, summary.SCORE_PERCENTILES))


def test_column_kinds(spark):
    df = spark.createDataFrame([(1, "a", True)], "i int, s string, b boolean")
    assert summary.numeric_columns(df) == ["i"] and summary.other_columns(df) == ["s", "b"]
