"""One job entry for all layers: python -m tidemark.job STEP --root ROOT --start DATE [--end DATE] ...

A step covers every snapshot from --start to --end in one Spark application and
rewrites just those partitions; with --missing only monthly snapshots that have
no output yet. Training and scoring first ask whether they are due.
"""

from __future__ import annotations

import argparse
import datetime as dt
import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, month_calendar, months_before, rolling_spans
from tidemark.operators.bin_state import STATE_SCHEMA
from tidemark.operators.decisions import (
    AUC_FLOOR, CSI_LIMIT, GINI_FLOOR, PSI_LIMIT, drift_decision, inference_gate, missing_snapshots, not_yet_run,
    resolve_model, training_gate,
)
from tidemark.operators.joins import Colocated
from tidemark.operators.stability import monitoring_baseline
from tidemark.operators.summary import feature_columns, numeric_columns, score_summary
from tidemark.plans import bronze, carried, dataset, gold, monitoring, scoring, silver
from tidemark.session import get_session, scratch_scope, write_and_reread
from tidemark.sources import claims, files, sinks, tables, versions
from tidemark.sources.metric_log import MetricLog
from tidemark.sources.schemas import BASELINE_SCHEMA, ID_COLUMNS, LABEL_SCHEMA, PREDICTION_SCHEMA

MODEL = "credit_model"
SOURCES = ["loans", "clickstream", "attributes", "financials"]
REGISTRY_SCHEMA = "name string, version int, last_updated timestamp, path string, train_date date"
RUN_SCHEMA = "step string, run_date date, finished_at timestamp"
DATED = "snapshot_date date"
MIN_MONTHS = 20


class Store:
    """Where the tables of one data mart lie."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, start=None, end=None, schema=None) -> DataFrame:
        """A table; with `schema` it may be absent and then has no rows."""
        if schema is not None:
            return tables.read_or_empty(self.spark, self.path(name), schema, start, end)
        return tables.read_snapshots(self.spark, self.path(name), start, end)

    def write(self, df: DataFrame, name: str, start, end) -> None:
        versions.publish(df, self.path(name), start=start, end=end)


def run_bronze(store: Store, raw: str, start, end, sources=SOURCES) -> None:
    for source in sources:
        bronze.ingest(store.spark, raw, source, store.path(f"bronze/{source}"), start, end)


CLEAN = {"loans": silver.loans, "clickstream": silver.clickstream,
         "attributes": silver.attributes, "financials": silver.financials}


def run_silver(store: Store, start, end, sources=SOURCES) -> None:
    """Cleaned tables; a source that was never ingested gives none."""
    for source in sources:
        rows = store.read(f"bronze/{source}", start, end, tables.empty_bronze(store.spark, source).schema)
        store.write(CLEAN[source](rows), f"silver/{source}", start, end)


def run_gold(store: Store, start, end, carry: bool = False) -> None:
    """Label and feature stores; a source without a cleaned table counts as one without rows.

    With `carry` the engagement panel goes on from the state of the snapshot
    before `start`, and reads the clicks from there on instead of six months back.
    """
    def cleaned(source, *dates):
        clean = silver.financial_columns if source == "financials" else CLEAN[source]
        return store.read(f"silver/{source}", *dates, schema=clean(tables.empty_bronze(store.spark, source)).schema)

    labels = gold.label_store(cleaned("loans", start, end))
    store.write(labels, "gold/labels", start, end)
    clicks = cleaned("clickstream").filter(
        F.col("snapshot_date").between(months_before(as_date(start), gold.LOOK_BACK), as_date(end)))
    if carry:
        panel = carried.CarriedPanel(store.spark, store.path("gold/engagement_state"))
        panel.build(clicks, dt.date.fromisoformat(start).replace(day=1), dt.date.fromisoformat(end).replace(day=1))
        engagement = carried.engagement_store(panel, clicks, start, end)
    else:
        engagement = gold.engagement_store(clicks, start, end)
    store.write(engagement, "gold/engagement", start, end)
    risk = gold.risk_store(cleaned("financials", start, end), cleaned("attributes"))
    store.write(risk, "gold/risk", start, end)


def missing_spans(store: Store, names, start, end) -> list[tuple]:
    """(first, last) of each run of months from `start` to `end` for which one of the tables has no snapshot.

    The months are a calendar, so their list is short whatever the tables hold.
    """
    months = write_and_reread(month_calendar(store.spark, start, end), "months")
    lacking = None
    for name in names:
        one = missing_snapshots(months, store.read(name, start, end, DATED))
        lacking = one if lacking is None else lacking.union(one)
    wanted = {r[0] for r in lacking.distinct().collect()}
    spans, last = [], None
    for month in (r[0] for r in months.orderBy("snapshot_date").collect()):
        if month in wanted:
            spans = [*spans[:-1], (spans[-1][0], month)] if last in wanted else [*spans, (month, month)]
        last = month
    return [(str(a), str(b)) for a, b in spans]


def why_not(store: Store, step: str, date: str, min_months: int = MIN_MONTHS, name: str = MODEL) -> str | None:
    """Why "train" or "score" is not due on a date; None where it is.

    Training asks for a quarter month, enough months of labels and no finished
    run of the date; scoring for more than `min_months` months of features and a model.
    """
    run = store.spark.range(1).select(as_date(date).alias("run_date"))
    if step == "score":
        gate = inference_gate(run, store.read("gold/risk", schema=DATED), resolved_model(store, name), min_months).first()
        return None if gate["infer"] else f"no model, or not more than {min_months} months of features: {gate['n_months']}"
    done = store.read("runs", schema=RUN_SCHEMA).filter(F.col("step") == step)
    if not_yet_run(run, done).isEmpty():
        return "this date was trained before"
    if claims.state(store.spark, store.path(f"claims/train={date}")) == "held":
        return "another run trains this date"
    gate = training_gate(run, store.read("gold/labels", schema=DATED), min_months).first()
    return None if gate["train"] else f"no quarter month, or fewer than {min_months} months of labels: {gate['n_months']}"


def mark_run(store: Store, step: str, date: str) -> None:
    store.spark.range(1).select(
        F.lit(step).alias("step"), as_date(date).alias("run_date"), F.current_timestamp().alias("finished_at"),
    ).write.mode("append").parquet(store.path("runs"))


def log_metrics(store: Store, df: DataFrame) -> None:
    MetricLog(store.spark, store.path("gold/metrics")).append(df)


def run_compaction(store: Store, before=None) -> int | None:
    """Merge the metric samples taken before a date (all without one) into one row per label set, and drop old files."""
    log = MetricLog(store.spark, store.path("gold/metrics"))
    number = log.merge(before)
    log.clean()
    return number


def run_training(store: Store, train_date: str, draws: int = 100, space=None, name: str = MODEL, again: bool = False,
                 lease_hours: float = claims.LEASE_HOURS) -> str:
    """Fit, evaluate and register a model; returns its id.

    A date is trained once: the run claims it first, and `claims.Taken` is raised
    where another run holds the claim or, without `again`, has finished. A run
    that fails gives its claim back; one that is killed loses it when the lease
    ends. Versions are numbers that no other run gets, and a model is known from
    its record in the registry on, which comes last.
    """
    claim = claims.take(store.spark, store.path(f"claims/train={train_date}"), lease_hours, again)
    try:
        model_id = _train(store, train_date, draws, space, name, claim)
    except BaseException as error:
        claims.fail(store.spark, claim, error=str(error)[:1000])
        raise
    claims.finish(store.spark, claim, model_id=model_id)
    return model_id


def _train(store: Store, train_date: str, draws: int, space, name: str, claim: claims.Claim) -> str:
    spark = store.spark
    stores = laid_out(store)
    rows = dataset.training_set_in_place(stores, train_date) if stores else dataset.training_set(
        store.read("gold/labels"), store.read("gold/risk"), train_date)
    features = feature_columns(rows, [*ID_COLUMNS, "period"])
    keyed = rows.withColumn("row_key", F.sha2(F.to_json(F.struct("*")), 256))
    rows = write_and_reread(dataset.with_split(keyed, ["row_key"], train_date), "training")
    train = write_and_reread(dataset.with_folds(rows.filter("split = 'train'"), ["row_key"]), "folds")
    model, parameters, cv_score = scoring.search(train, features, draws=draws, space=space)

    version = claims.reserve(spark, store.path(f"versions/{name}"))
    model_id = f"{name}_{version}"
    path = store.path(f"models/{model_id}")
    model.write().save(path)

    numeric = numeric_columns(rows.select(*features))
    scored = scoring.score(model, rows, "score").select("split", "label", "score", *numeric)
    scored = write_and_reread(scored, "scored")
    baseline = monitoring_baseline(scored.filter("split = 'train'"), numeric)
    baseline = write_and_reread(baseline, "baseline")
    sinks.write_snapshots(baseline.withColumn("model_id", F.lit(model_id)), store.path("baseline"), by=("model_id",))
    sinks.write_baseline_json(baseline, features, numeric, store.path(f"bins/{model_id}"))

    performance = scoring.split_performance(scored, "score")
    stability = scoring.split_stability(scored, numeric, score_col="score")
    wide = performance.join(stability.withColumnRenamed("compared", "split"), "split", "left")
    values = ["n", "positive_rate", "auc", "gini", "psi_score", "csi_mean", "csi_max"]
    long = wide.selectExpr("split", *[f"double({v}) as {v}" for v in values]).unpivot(["split"], values, "metric", "value")
    cv = spark.range(1).select(F.lit("cv_balanced_accuracy").alias("metric"), F.lit(float(cv_score)).alias("value"))
    settings = spark.createDataFrame(
        [(f"parameter_{k}", float(v)) for k, v in parameters.items()], "metric string, value double")
    logged = long.select(F.concat_ws("_", "metric", "split").alias("metric"), "value").unionByName(cv).unionByName(settings)
    log_metrics(store, logged.filter("value is not null").select(
        "metric", as_date(train_date).alias("snapshot_date"), F.lit(model_id).alias("model_id"), "value",
        F.current_timestamp().alias("logged_at")))

    if not claims.is_mine(spark, claim):
        raise claims.Taken(f"the claim on {train_date} was lost while it was trained")
    record = {"name": name, "version": version, "last_updated": dt.datetime.now(dt.timezone.utc).isoformat(),
              "path": path, "train_date": train_date}
    if not claims.compare_and_set(spark, store.path(f"registry/{name}"), version, record):
        raise claims.Taken(f"version {version} of {name} was registered by another run")
    mark_run(store, "train", train_date)
    return model_id


def model_files(store: Store, name: str = MODEL) -> DataFrame:
    """(file, modified): saved models by folder name and a suffix, and the newest change of their description; none where nothing was saved."""
    at = store.path("models")
    if not files.exists(store.spark, at):
        return tables.empty_table(store.spark, "file string, modified timestamp")
    folder = F.regexp_extract("path", r"/models/([^/]+)/metadata/[^/]+$", 1)
    listed = tables.list_files(store.spark, at, "part-*").select(folder.alias("model"), "modificationTime")
    return listed.filter(F.col("model").rlike(rf"^{re.escape(name)}_[0-9]+$")).groupBy(
        F.concat("model", F.lit(".dir")).alias("file")).agg(F.max("modificationTime").alias("modified"))


def run_layout(store: Store) -> str:
    """Lay out the label and feature stores by customer as they are now, and make that known; the layout's folder.

    Training and scoring use the newest layout as long as it was made from the
    newest manifests of both stores, and join plain tables otherwise.
    """
    spark = store.spark
    made_from = _gold_manifests(store)
    number = claims.reserve(spark, store.path("layouts/reserved"))
    at = f"layouts/{number:08d}"
    dataset.lay_out(spark, store.path(at), store.read("gold/labels"), store.read("gold/risk"))
    claims.compare_and_set(spark, store.path("layouts/known"), number, {"number": number, "path": at, "made_from": made_from})
    return at


def _gold_manifests(store: Store) -> str:
    return "/".join(str(max(versions.numbers(store.spark, store.path(f"gold/{t}")), default=0)) for t in ("labels", "risk"))


def laid_out(store: Store) -> Colocated | None:
    """The newest layout of the label and feature stores, None where it is older than they are."""
    known = claims.records(store.spark, store.path("layouts/known"), "number int, path string, made_from string")
    newest = known.orderBy(F.desc("number")).first()
    if newest is None or newest["made_from"] != _gold_manifests(store):
        return None
    return Colocated(store.spark, store.path(newest["path"]))


def resolved_model(store: Store, name: str = MODEL, as_of=None) -> DataFrame:
    """The newest registered version, else the newest saved model."""
    registry = claims.records(store.spark, store.path("registry"), REGISTRY_SCHEMA)
    return resolve_model(registry, model_files(store, name), name, as_of)


def current_model(store: Store, name: str = MODEL, as_of=None) -> str | None:
    return resolved_model(store, name, as_of).first()["model_id"]


def stored_baseline(store: Store, model_id: str) -> DataFrame:
    """A model's bins from the table, else from the file beside it; no rows where neither was written."""
    spark = store.spark
    held = tables.read_or_empty(spark, store.path("baseline"), BASELINE_SCHEMA).filter(F.col("model_id") == model_id).drop("model_id")
    if held.isEmpty() and files.exists(spark, store.path(f"bins/{model_id}")):
        return tables.read_baseline_json(spark, store.path(f"bins/{model_id}")).drop("source")
    return held


def run_scoring(store: Store, snapshot: str, name: str = MODEL, as_of=None, psi_limit: float = PSI_LIMIT,
                csi_limit: float = CSI_LIMIT) -> str:
    """Score the cohort of a snapshot with the newest model and record its drift."""
    spark = store.spark
    model_id = current_model(store, name, as_of)
    if model_id is None:
        raise ValueError(f"no model registered or saved under {name}")
    model = PipelineModel.load(store.path(f"models/{model_id}"))
    stores = laid_out(store)
    cohort = dataset.scoring_cohort_in_place(stores, snapshot) if stores else dataset.scoring_cohort(
        store.read("gold/labels"), store.read("gold/risk"), snapshot)
    scored = write_and_reread(scoring.score(model, cohort), "scored")
    written = scoring.predictions(scored, f"models:/{name}/{model_id.rsplit('_', 1)[1]}", model_id)
    versions.publish(
        written.withColumn("written_at", F.current_timestamp()), store.path("gold/predictions"), monitoring.BY_MODEL)

    baseline = stored_baseline(store, model_id)
    rows = scored.withColumnRenamed("model_predictions", "score").withColumn("model_id", F.lit(model_id))
    numeric = numeric_columns(rows, exclude=["score"])
    versions.publish(monitoring.scored_state(rows, numeric, baseline), store.path("gold/bin_counts"), monitoring.BY_MODEL)
    counts = store.read("gold/bin_counts", snapshot, snapshot).filter(F.col("model_id") == model_id)
    records = write_and_reread(monitoring.drift_from_state(
        counts, baseline, psi_limit=psi_limit, csi_limit=csi_limit), "drift")
    sinks.write_drift(records, store.path("gold/drift"))
    log_metrics(store, monitoring.drift_metrics(records))
    summary = score_summary(rows, "score", monitoring.KEYS)
    log_metrics(store, sinks.metric_rows(
        summary, {f"ml_score_{c}": F.col(c) for c in summary.columns if c not in monitoring.KEYS}))
    return model_id


def run_drift(store: Store, start, end, months: int = 3, psi_limit: float = PSI_LIMIT, csi_limit: float = CSI_LIMIT) -> DataFrame:
    """Drift of each model over the `months` months that end with each month of `start`..`end`, from stored counts alone.

    Each model is held against its own baseline. A month that was never scored
    adds nothing; spans without any scored snapshot have no row.
    """
    spark = store.spark
    counts = store.read("gold/bin_counts", schema=f"{STATE_SCHEMA}, model_id string, snapshot_date date")
    baseline = store.read("baseline", schema=BASELINE_SCHEMA)
    found = monitoring.span_drift(
        counts, rolling_spans(spark, start, end, months), baseline, ["model_id"], psi_limit, csi_limit)
    versions.publish(found, store.path("gold/span_drift"), ["last"])
    return store.read("gold/span_drift").filter(F.col("last").between(as_date(start), F.last_day(as_date(end))))


def run_monitoring(store: Store, snapshot: str, auc_floor: float = AUC_FLOOR, gini_floor: float = GINI_FLOOR) -> dict[str, str]:
    """Retrain decisions of a snapshot: from drift, then from performance where labels exist.

    Without predictions, drift records or labels both decisions are to pass.
    """
    spark = store.spark
    drift = tables.read_drift(spark, store.path("gold/drift"), snapshot=snapshot)
    written = store.read("gold/predictions", snapshot, snapshot, PREDICTION_SCHEMA)
    dated = drift.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).join(
        written.groupBy("snapshot_date", "model_id").agg(F.max("written_at").alias("written_at")),
        ["snapshot_date", "model_id"])
    wanted = spark.range(1).select(as_date(snapshot).alias("snapshot_date"))
    by_drift = drift_decision(dated, wanted).first()["decision"]
    labels = store.read("gold/labels", snapshot, snapshot, LABEL_SCHEMA)
    records = write_and_reread(monitoring.performance_records(written, labels, auc_floor, gini_floor), "performance")
    log_metrics(store, monitoring.performance_metrics(records, auc_floor=auc_floor, gini_floor=gini_floor))
    row = records.first()
    return {"drift": by_drift, "performance": row["decision"] if row else "pass"}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark.job", description=__doc__)
    parser.add_argument("step", choices=["bronze", "silver", "gold", "train", "score", "monitor", "drift", "layout", "compact"])
    parser.add_argument("--root", required=True, help="folder of the data mart")
    parser.add_argument("--raw", help="folder of the raw CSV files (bronze)")
    parser.add_argument("--start", required=True, help="first snapshot, YYYY-MM-DD; the only one for train/score/monitor")
    parser.add_argument("--end", help="last snapshot, the first by default")
    parser.add_argument("--source", choices=SOURCES, action="append", help="only these sources (bronze, silver)")
    parser.add_argument("--draws", type=int, default=100, help="parameter sets to try (train)")
    parser.add_argument("--lease-hours", type=float, default=claims.LEASE_HOURS, help="a run that says nothing for so long is dead (train)")
    parser.add_argument("--carry", action="store_true", help="engagement panel from the state of the month before (gold)")
    parser.add_argument("--missing", action="store_true", help="only monthly snapshots without output (bronze, silver, gold)")
    parser.add_argument("--force", action="store_true", help="train or score even where it is not due")
    parser.add_argument("--min-months", type=int, default=MIN_MONTHS, help="months of history (train, score)")
    parser.add_argument("--months", type=int, default=3, help="months of a span (drift)")
    parser.add_argument("--psi-limit", type=float, default=PSI_LIMIT, help="drift from here on (score, drift)")
    parser.add_argument("--csi-limit", type=float, default=CSI_LIMIT, help="drift from here on (score, drift)")
    parser.add_argument("--auc-floor", type=float, default=AUC_FLOOR, help="too weak below this (monitor)")
    parser.add_argument("--gini-floor", type=float, default=GINI_FLOOR, help="too weak below this (monitor)")
    args = parser.parse_args(argv)
    store, end, sources = Store(get_session(), args.root), args.end or args.start, args.source or SOURCES
    with scratch_scope(store.spark):  # each step publishes its results
        run_step(store, args, end, sources)


def run_step(store: Store, args, end, sources) -> None:
    if args.step in ("bronze", "silver", "gold"):
        outputs = ["gold/labels", "gold/risk"] if args.step == "gold" else [f"{args.step}/{s}" for s in sources]
        for start, last in missing_spans(store, outputs, args.start, end) if args.missing else [(args.start, end)]:
            if args.step == "bronze":
                run_bronze(store, args.raw, start, last, sources)
            elif args.step == "silver":
                run_silver(store, start, last, sources)
            else:
                run_gold(store, start, last, args.carry)
    elif args.step == "compact":
        print(run_compaction(store, args.start))
    elif args.step == "layout":
        print(run_layout(store))
    elif args.step == "drift":
        run_drift(store, args.start, end, args.months, args.psi_limit, args.csi_limit).orderBy("last", "model_id").show(truncate=False)
    elif args.step == "monitor":
        print(run_monitoring(store, args.start, args.auc_floor, args.gini_floor))
    elif not args.force and (reason := why_not(store, args.step, args.start, args.min_months)):
        print(f"not due: {reason}")
    elif args.step == "train":
        try:
            print(run_training(store, args.start, args.draws, again=args.force, lease_hours=args.lease_hours))
        except claims.Taken as error:
            print(f"not due: {error}")
    else:
        print(run_scoring(store, args.start, psi_limit=args.psi_limit, csi_limit=args.csi_limit))


if __name__ == "__main__":
    main()
