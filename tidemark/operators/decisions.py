"""Monitoring flags, retrain decisions and run eligibility as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import is_quarter_month, month_start
from tidemark.functions.text import all_digits, model_id_of_file, model_id_of_uri, uri_part
from tidemark.operators.bounded import lookup, stored

PSI_LIMIT = 0.25
CSI_LIMIT = 0.25
AUC_FLOOR = 0.70
GINI_FLOOR = 0.30


def reaches(metric: Column, limit: Column) -> Column:
    return F.coalesce(metric >= limit, F.lit(False))


def drift_flags(df: DataFrame, psi_limit: float = PSI_LIMIT, csi_limit: float = CSI_LIMIT) -> DataFrame:
    """Drift records from (snapshot_date, model_id, psi_score, csi_max)."""
    return df.select(
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        "model_id", "psi_score", "csi_max",
        reaches(F.col("psi_score"), F.lit(psi_limit)).alias("psi_breach"),
        reaches(F.col("csi_max"), F.lit(csi_limit)).alias("csi_breach"),
        F.lit(float(psi_limit)).alias("psi_threshold"),
        F.lit(float(csi_limit)).alias("csi_threshold"),
    )


def latest_by(df: DataFrame, by, order) -> DataFrame:
    """The last row of each group in the order of the given columns."""
    order = list(order)
    rest = [c for c in df.columns if c not in by]
    key = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*by).agg(F.max(key).alias("last")).select(*by, *[F.col(f"last.{c}").alias(c) for c in rest])


def drift_decision(records: DataFrame, snapshots: DataFrame, written_at: str = "written_at") -> DataFrame:
    """(snapshot_date, model_id, psi_breach, csi_breach, decision) from each snapshot's newest record.

    A snapshot without a record passes, and so does a missing metric; a missing
    threshold counts as the default.
    """
    newest = latest_by(
        records.select(F.col("snapshot_date").cast("date").alias("snapshot_date"), written_at, "model_id",
                       "psi_score", "csi_max", "psi_threshold", "csi_threshold"),
        ["snapshot_date"], [written_at, "model_id"])
    psi = reaches(F.col("psi_score"), F.coalesce("psi_threshold", F.lit(PSI_LIMIT)))
    csi = reaches(F.col("csi_max"), F.coalesce("csi_threshold", F.lit(CSI_LIMIT)))
    return snapshots.select("snapshot_date").join(newest, "snapshot_date", "left").select(
        "snapshot_date", "model_id", psi.alias("psi_breach"), csi.alias("csi_breach"),
        F.when(psi | csi, "retrain").otherwise("pass").alias("decision"))


def performance_flags(df: DataFrame, auc_floor: float = AUC_FLOOR, gini_floor: float = GINI_FLOOR) -> DataFrame:
    """Add auc_breach, gini_breach and breach to a table with auc and gini."""
    def below(metric, floor):
        return F.coalesce(F.col(metric) < floor, F.lit(False))

    return df.withColumns({
        "auc_breach": below("auc", auc_floor),
        "gini_breach": below("gini", gini_floor),
        "breach": below("auc", auc_floor) | below("gini", gini_floor),
    })


def performance_decision(breach: Column) -> Column:
    return F.when(breach, "retrain").otherwise("done")


def months_up_to(runs: DataFrame, months: DataFrame) -> DataFrame:
    """Add n_months: how many of the distinct months start no later than each run date.

    The months are a calendar, so they travel as one array.
    """
    calendar = months.agg(F.array_sort(F.collect_set("month")).alias("__months"))
    seen = F.size(F.filter("__months", lambda m: m <= F.col("run_date")))
    return lookup(runs, calendar, []).withColumn("n_months", seen).drop("__months")


def month_of_first_row(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """(month, first_date): each month present and its earliest date."""
    return df.filter(F.col(column).isNotNull()).groupBy(month_start(F.col(column)).alias("month")).agg(
        F.min(column).cast("date").alias("first_date"))


def _history(runs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Add n_months: distinct months with a snapshot dated no later than the run date."""
    firsts = month_of_first_row(snapshots).select(F.col("first_date").alias("month"))
    return months_up_to(runs, firsts)


def training_gate(runs: DataFrame, labels: DataFrame, min_months: int = 20, quarter_months=(3, 6, 9, 12)) -> DataFrame:
    """(run_date, n_months, train): quarter months with enough label months up to then."""
    ok = is_quarter_month(F.col("run_date"), quarter_months) & (F.col("n_months") >= min_months)
    return _history(runs.select("run_date"), labels).select("run_date", "n_months", ok.alias("train"))


def inference_gate(runs: DataFrame, features: DataFrame, models: DataFrame, more_than: int = 20) -> DataFrame:
    """(run_date, n_months, infer): more than `more_than` feature months and a model at hand.

    `models` is the output of `resolve_model`; no row, or a NULL model, means none.
    """
    found = models.agg(F.coalesce(F.bool_or(F.col("model").isNotNull()), F.lit(False)).alias("found"))
    gated = lookup(_history(runs.select("run_date"), features), found, [])
    return gated.select(
        "run_date", "n_months", ((F.col("n_months") > more_than) & F.col("found")).alias("infer"))


def resolve_model(registry: DataFrame, artefacts: DataFrame, name: str, as_of=None) -> DataFrame:
    """One row (model, model_id, source): the newest registered version, else the newest file.

    `registry` has (name, version, last_updated), `artefacts` (file, modified).
    """
    if as_of is not None:
        registry = registry.filter(F.col("last_updated") <= as_of)
        artefacts = artefacts.filter(F.col("modified") <= as_of)
    version = registry.filter(F.col("name") == name).agg(
        F.max_by(F.col("version").cast("string"), F.struct("last_updated", F.col("version").cast("long"))))
    file = artefacts.agg(F.max_by("file", F.struct("modified", "file")))
    uri = F.concat(F.lit(f"models:/{name}/"), F.col("version"))
    both = artefacts.sparkSession.range(1).select(version.scalar().alias("version"), file.scalar().alias("file"))
    return both.select(
        F.coalesce(uri, F.col("file")).alias("model"),
        F.coalesce(model_id_of_uri(uri), model_id_of_file(F.col("file"))).alias("model_id"),
        F.when(uri.isNotNull(), "registry").when(F.col("file").isNotNull(), "file").alias("source"),
    )


def uri_fields(df: DataFrame, uri: str) -> DataFrame:
    """Add model_name, model_version (digits only), model_stage and model_id of an address column."""
    last = uri_part(F.col(uri), 2)
    return df.withColumns({
        "model_name": uri_part(F.col(uri), 1),
        "model_version": F.when(all_digits(last), last.try_cast("int")),
        "model_stage": F.when(~all_digits(last), last),
        "model_id": model_id_of_uri(F.col(uri)),
    })


def newest_predictions(predictions: DataFrame, written_at: str = "written_at") -> DataFrame:
    """The prediction rows of the last-written model of each snapshot."""
    written = predictions.groupBy("snapshot_date", "model_id").agg(F.max(written_at).alias("at"))
    pick = latest_by(written, ["snapshot_date"], ["at", "model_id"]).select("snapshot_date", "model_id")
    return predictions.join(stored(pick), ["snapshot_date", "model_id"], "left_semi")


def missing_snapshots(expected: DataFrame, present: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Expected dates that have no output yet."""
    dates = present.select(F.col(column).cast("date").alias(column)).distinct()
    return expected.select(column).join(dates, column, "left_anti")


def not_yet_run(runs: DataFrame, done: DataFrame, column: str = "run_date") -> DataFrame:
    """Run dates without a marker in the table of finished runs."""
    return runs.join(done.select(column).distinct(), column, "left_anti")


def any_known(df: DataFrame, column: str) -> DataFrame:
    """One row (found): whether any row has a value in the column."""
    return df.agg(F.coalesce(F.bool_or(F.col(column).isNotNull()), F.lit(False)).alias("found"))

