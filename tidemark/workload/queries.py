"""The runnable queries: name -> (session, table folder) -> DataFrame.

Each reads its whole tables. The SQL in `oracle` computes the same columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, encode, text
from tidemark.operators import bin_state as bins
from tidemark.operators import decisions, distinct, ranking, sketches, stability, stratify, summary
from tidemark.operators.bounded import stored
from tidemark.operators.joins import left_join
from tidemark.operators.quantiles import cap_at_quantile, exact_quantiles
from tidemark.plans import bronze, carried, dataset, gold, monitoring, scoring, silver, trees
from tidemark.session import scratch_path, write_and_reread
from tidemark.sources import metric_log, sinks, tables, versions
from tidemark.sources.schemas import (
    CAPPED_COLUMNS, COUNT_COLUMNS, DRIFT_SCHEMA, FRACTION_COLUMNS, LOAN_TYPES, METRIC_SCHEMA, MODEL_FEATURES, MONEY_COLUMNS, ID_COLUMNS,
    RAW_FILES, RISK_FEATURES,
)
from tidemark.workload import standins as s

QUERIES = {}

TRAIN_DATE = "2000-09-01"
SNAPSHOT = "2000-06-15"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PANEL = ("1995-01-01", "2001-08-01")


def query(f):
    QUERIES[f"q_{f.__name__}"] = f
    return f


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison; adding zero turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) + F.lit(0.0) for c in columns})


def rounded_array(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Arrays of doubles as one text, each element with `places` decimals."""
    def fixed(c):
        return F.concat_ws(",", F.transform(c, lambda x: F.round(x, places).cast(f"decimal(30,{places})").cast("string")))

    return df.withColumns({c: fixed(F.col(c)) for c in columns})


def silver_loans(spark, folder):
    return silver.loans(s.raw_loans(spark, folder))


def label_store_(spark, folder):
    return gold.label_store(silver_loans(spark, folder))


def risk_store_(spark, folder):
    return gold.risk_store(
        silver.financials(s.raw_financials(spark, folder)), silver.attributes(s.raw_attributes(spark, folder)))


def stored_risk_store(spark, folder):
    """The risk store as training and scoring meet it: a written table."""
    return write_and_reread(risk_store_(spark, folder), "risk-store")


def lineitem(spark, folder):
    return s.table(spark, folder, "lineitem")


def orders(spark, folder):
    return s.table(spark, folder, "orders")


# --- sources and layers --------------------------------------------------------------------------------

@query
def bronze_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze(s.raw_loans(spark, folder), SNAPSHOT)


@query
def bronze_range(spark, folder):
    return bronze.bronze(s.raw_loans(spark, folder), "2000-06-01", "2000-06-30").groupBy("snapshot_date").agg(
        F.count("*").alias("rows"))


@query
def bronze_sources(spark, folder):
    raw = {"loans": s.raw_loans, "clickstream": s.raw_clicks, "attributes": s.raw_attributes,
           "financials": s.raw_financials}
    parts = [
        bronze.bronze(build(spark, folder)).groupBy(F.lit(name).alias("source"), "snapshot_date").agg(F.count("*").alias("rows"))
        for name, build in raw.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def raw_csv(spark, folder):
    path = scratch_path(spark, "raw-csv")
    s.raw_attributes(spark, folder).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return silver.attributes(bronze.bronze(tables.read_raw(spark, path)))


def _ingested(spark, folder, source, build):
    """The whole raw table as a CSV file, ingested as the job does, and read back from its snapshots."""
    raw = scratch_path(spark, "raw")
    build(spark, folder).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(f"{raw}/{RAW_FILES[source]}")
    out = scratch_path(spark, "bronze")
    bronze.ingest(spark, raw, source, out, *s.ALL_DATES)
    return tables.read_snapshots(spark, out, *s.ALL_DATES)


@query
def bronze_loans_csv(spark, folder):
    return _ingested(spark, folder, "loans", s.raw_loans)


@query
def bronze_clickstream_csv(spark, folder):
    return _ingested(spark, folder, "clickstream", s.raw_clicks)


@query
def bronze_attributes_csv(spark, folder):
    return _ingested(spark, folder, "attributes", s.raw_attributes)


@query
def bronze_financials_csv(spark, folder):
    return _ingested(spark, folder, "financials", s.raw_financials)


@query
def snapshot_rewrite(spark, folder):
    """All snapshots, one rewritten and one emptied, each through a manifest of its own."""
    path = scratch_path(spark, "snapshots")
    rows = silver.clickstream(s.raw_clicks(spark, folder)).select("event_id", "Customer_ID", "fe_1", "snapshot_date")
    versions.publish(rows, path)
    again = tables.one_snapshot(rows, "1999-03-01").withColumn("fe_1", F.lit(-1))
    versions.publish(again, path)
    none = tables.one_snapshot(rows, "1999-05-01").filter("event_id < 0")
    versions.publish(none, path, start="1999-05-01", end="1999-05-01")
    return tables.read_snapshots(spark, path)


@query
def snapshot_versions(spark, folder):
    """Rows and oldest fe_1 per snapshot as of each of three manifests: all written, one rewritten, a range emptied."""
    path = scratch_path(spark, "snapshots")
    rows = silver.clickstream(s.raw_clicks(spark, folder)).select("event_id", "Customer_ID", "fe_1", "snapshot_date")
    versions.publish(rows, path)
    versions.publish(tables.one_snapshot(rows, "1999-03-01").withColumn("fe_1", F.lit(-1)), path)
    versions.publish(tables.one_snapshot(rows, "1999-05-01"), path, start="1999-04-01", end="2000-02-01")
    parts = [
        versions.read_published(spark, path, number=n).groupBy(F.lit(n).alias("manifest"), "snapshot_date").agg(
            F.count("*").alias("rows"), F.min("fe_1").alias("least"))
        for n in versions.numbers(spark, path)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def absent_sources(spark, folder):
    """Rows and columns of each source read together with a table that was never written."""
    raw = {"loans": s.raw_loans, "clickstream": s.raw_clicks, "attributes": s.raw_attributes, "financials": s.raw_financials}
    parts = []
    for source, build in raw.items():
        empty = tables.empty_bronze(spark, source)
        absent = tables.read_or_empty(spark, scratch_path(spark, "absent"), empty.schema)
        both = absent.unionByName(bronze.bronze(build(spark, folder)).select(*empty.columns))
        parts.append(both.groupBy(F.lit(source).alias("source"), F.lit(len(both.columns)).alias("columns")).agg(
            F.count("*").alias("rows"), F.count("snapshot_date").alias("dated")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def snapshot_catalogue(spark, folder):
    return tables.snapshot_months(orders(spark, folder), "2000-06-15", "o_orderdate")


@query
def snapshot_in_file_name(spark, folder):
    name = F.concat(F.when(F.col("o_orderkey") % 4 == 0, "silver_x_").otherwise("gold_label_store_"),
                    dates.path_suffix(F.col("o_orderdate")), F.lit(".parquet"))
    dated = orders(spark, folder).select(tables.snapshot_in_name(name, "gold_label_store").alias("snapshot_date"))
    return dated.groupBy("snapshot_date").agg(F.count("*").alias("files"))


@query
def schema_enforce(spark, folder):
    typed = silver.enforce_schema(s.raw_loans(spark, folder), LOAN_TYPES)
    return rounded(typed, "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance", places=2)


@query
def clickstream_silver(spark, folder):
    return silver.clickstream(s.raw_clicks(spark, folder))


@query
def loan_dpd(spark, folder):
    return silver_loans(spark, folder).select(
        "loan_id", "Customer_ID", "mob", "installments_missed", "first_missed_date", "dpd", "snapshot_date")


@query
def attr_clean(spark, folder):
    return silver.attributes(s.raw_attributes(spark, folder))


@query
def currency_clean(spark, folder):
    cleaned = silver.financial_values(s.raw_financials(spark, folder)).select(
        "record_id", *MONEY_COLUMNS, *COUNT_COLUMNS, *FRACTION_COLUMNS)
    return rounded(cleaned, *MONEY_COLUMNS, *FRACTION_COLUMNS)


@query
def currency_signed(spark, folder):
    raw = s.raw_financials(spark, folder)
    return raw.select(
        "record_id",
        text.money(F.col("Monthly_Balance"), "null").alias("balance_null"),
        text.money(F.col("Monthly_Balance"), "keep").alias("balance_keep"),
        text.integer_text(F.col("Delay_from_due_date"), "null").alias("delay_null"),
        text.integer_text(F.col("Delay_from_due_date"), "keep").alias("delay_keep"),
    )


@query
def history_months(spark, folder):
    return s.raw_financials(spark, folder).select(
        "record_id", text.history_months(F.col("Credit_History_Age")).alias("months"))


@query
def encode_ordinal(spark, folder):
    raw = s.raw_financials(spark, folder)
    return raw.select(
        "record_id",
        encode.credit_mix(F.col("Credit_Mix")).alias("Credit_Mix"),
        encode.member_or_null(F.col("Credit_Mix"), encode.CREDIT_MIXES).alias("Credit_Mix_text"),
        encode.yes_no(F.col("Payment_of_Min_Amount")).alias("Payment_of_Min_Amount"),
        encode.payment_behaviour(F.col("Payment_Behaviour")).alias("Payment_Behaviour"),
    )


@query
def p97_cap(spark, folder):
    return cap_at_quantile(orders(spark, folder).select(
        "o_orderkey", "o_totalprice", "o_custkey", F.trunc("o_orderdate", "MM").alias("snapshot_date")),
        ["o_totalprice", "o_custkey"])


def _monthly_orders(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey", "o_totalprice", "o_custkey", F.trunc("o_orderdate", "MM").alias("snapshot_date"))


CAPPED_ORDERS = ["o_totalprice", "o_custkey"]


def _stored_sketches(spark, folder):
    """A sketch per month and column, published as a binary column."""
    path = scratch_path(spark, "sketches")
    versions.publish(sketches.quantile_sketches(_monthly_orders(spark, folder), CAPPED_ORDERS, ["snapshot_date"]), path)
    return tables.read_snapshots(spark, path)


def _near(prob):
    """Whether the rank of a cap, among rows counted exactly, is within 0.01 n of the one wanted."""
    return F.expr(f"low <= ({prob} + 0.01) * n and high >= ({prob} - 0.01) * n")


@query
def sketch_caps(spark, folder):
    """Caps of every quarter and year from merged monthly sketches, held against the ranks of all rows."""
    spans = dates.calendar_spans(spark, *s.ALL_DATES, "quarter").unionByName(dates.calendar_spans(spark, *s.ALL_DATES, "year"))
    caps = stored(sketches.sketch_quantiles(sketches.over_spans(_stored_sketches(spark, folder), spans), [0.97]))
    by = ["span", "first", "last"]
    rows = _monthly_orders(spark, folder)
    placed = rows.join(spans, rows["snapshot_date"].between(spans["first"], spans["last"]))
    found = sketches.ranks_of(placed, CAPPED_ORDERS, caps, by)
    return found.join(caps.select(*by, "feature", F.col("n").alias("sketched")), [*by, "feature"]).select(
        *by, "feature", "n", "sketched", _near(0.97).alias("near"))


@query
def sketch_capped(spark, folder):
    """Rows capped by stored sketches: how many are cut in each month, and whether that is 3 of 100, give or take one."""
    rows = _monthly_orders(spark, folder)
    capped = cap_at_quantile(rows, CAPPED_ORDERS, sketches=_stored_sketches(spark, folder))
    both = rows.select("o_orderkey", *[F.col(c).alias(f"raw_{c}") for c in CAPPED_ORDERS]).join(capped, "o_orderkey")
    return both.groupBy("snapshot_date").agg(F.count("*").alias("n"), *[
        (F.sum((F.col(f"raw_{c}") > F.col(c)).cast("int")) <= 0.04 * F.count("*")).alias(f"{c}_near") for c in CAPPED_ORDERS],
        *[F.max(F.col(c) <= F.col(f"raw_{c}")).alias(f"{c}_held") for c in CAPPED_ORDERS])


@query
def cap_approximate(spark, folder):
    """Financial features with caps from sketches: known values per snapshot, and whether at most 4 of 100 are above the cap."""
    values = write_and_reread(silver.financial_values(s.raw_financials(spark, folder)).select(
        "record_id", "snapshot_date", *CAPPED_COLUMNS), "values")
    capped = cap_at_quantile(values, CAPPED_COLUMNS, approximate=True)
    long = [values.select("record_id", "snapshot_date", F.lit(c).alias("feature"), F.col(c).cast("double").alias("raw"))
            .join(capped.select("record_id", F.col(c).alias("value")), "record_id") for c in CAPPED_COLUMNS]
    rows = long[0]
    for one in long[1:]:
        rows = rows.unionByName(one)
    return rows.filter("raw is not null").groupBy("snapshot_date", "feature").agg(
        F.count("*").alias("n"), (F.sum((F.col("raw") > F.col("value")).cast("int")) <= 0.04 * F.count("*")).alias("near"))


@query
def fin_features(spark, folder):
    out = silver.financials(s.raw_financials(spark, folder)).select(
        "record_id", "Customer_ID", "snapshot_date", *CAPPED_COLUMNS, "Credit_Mix", "Payment_of_Min_Amount",
        *RISK_FEATURES[:4])
    return rounded(out, "Loans_per_Credit_Item", "Debt_to_Salary")


@query
def label_store(spark, folder):
    return label_store_(spark, folder)


@query
def default_rate(spark, folder):
    labels = label_store_(spark, folder).withColumn("month", dates.month_start(F.col("snapshot_date")))
    return ranking.positive_rate(labels, "label", ["month"], places=4)


@query
def engagement_pivot(spark, folder):
    clicks = s.raw_clicks(spark, folder)
    return gold.engagement_panel(silver.clickstream(clicks), *PANEL, order="event_id")


@query
def engagement_scaffold(spark, folder):
    return gold.engagement_scaffold(silver.clickstream(s.raw_clicks(spark, folder)), *PANEL)


@query
def engagement_store(spark, folder):
    return gold.engagement_store(silver.clickstream(s.raw_clicks(spark, folder)), *PANEL, order="event_id")


@query
def engagement_by_value(spark, folder):
    """The engagement store as the job builds it, with the smallest fe_1 of a month, and busy customers reduced first."""
    clicks = silver.clickstream(s.raw_clicks(spark, folder))
    return gold.engagement_panel(clicks, *PANEL, hot_rows=20).unionByName(gold.engagement_scaffold(clicks, *PANEL))


def _carried(spark, folder, step, order="event_id"):
    clicks = write_and_reread(silver.clickstream(s.raw_clicks(spark, folder)).select(
        "Customer_ID", "snapshot_date", "fe_1", "event_id"), "clicks")
    panel = carried.CarriedPanel(spark, scratch_path(spark, "carried"), order)
    first, last = (date.fromisoformat(d) for d in PANEL)
    return panel, clicks, first, last, step


@query
def engagement_carried(spark, folder):
    """The engagement store from states that are carried on, a year of snapshots at a time."""
    panel, clicks, first, last, step = _carried(spark, folder, 12)
    panel.build(clicks, first, last, step)
    return carried.engagement_store(panel, clicks, *PANEL)


@query
def engagement_late_month(spark, folder):
    """Carried states to which the clicks of one month came late, the six that look back on it made again."""
    panel, clicks, first, last, step = _carried(spark, folder, 24)
    month = date(1998, 5, 1)
    panel.build(clicks.filter(F.col("snapshot_date") != F.lit(month)), first, last, step)
    panel.late(clicks, month)
    return panel.panel(*PANEL)


@query
def daily_panel(spark, folder):
    events = s.table(spark, folder, "events")
    day = F.to_date("ts")
    per_day = events.groupBy(F.col("user_id"), day.alias("day")).agg(F.count("*").cast("int").alias("n"))
    served = per_day.withColumn("days_ago", F.explode(F.sequence(F.lit(1), F.lit(6)))).withColumn(
        "day", F.date_add("day", F.col("days_ago")))
    wide = served.groupBy("user_id", "day").pivot("days_ago", [1, 2, 3, 4, 5, 6]).agg(F.first("n"))
    return wide.withColumnsRenamed({str(i): f"events_{i}d" for i in range(1, 7)})


@query
def risk_store(spark, folder):
    return rounded(risk_store_(spark, folder), "Loans_per_Credit_Item", "Debt_to_Salary")


# --- calendar and text ---------------------------------------------------------------------------------

@query
def month_calendar(spark, folder):
    first, last = orders(spark, folder).agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return dates.month_calendar(spark, first, last).select(
        "snapshot_date", dates.is_quarter_month(F.col("snapshot_date")).alias("quarter"),
        dates.path_suffix(F.col("snapshot_date")).alias("suffix"))


@query
def window_dates(spark, folder):
    day = F.to_date("l_shipdate")
    days = lineitem(spark, folder).select(day.alias("train_date")).distinct()
    return days.select("train_date", *[c.alias(n) for n, c in dates.training_windows(F.col("train_date")).items()])


@query
def model_addresses(spark, folder):
    order = F.col("o_orderkey").cast("string")
    last = F.when(F.col("o_orderkey") % 5 == 0, "Production").otherwise(order)
    addresses = orders(spark, folder).select(F.concat(F.lit("models:/risk_tree/"), last).alias("uri"))
    file = F.concat(F.lit("credit_model_"), order, F.lit(".pkl"))
    return decisions.uri_fields(addresses, "uri").unionByName(
        orders(spark, folder).select(file.alias("uri"), text.model_id_of_file(file).alias("model_id")),
        allowMissingColumns=True)


# --- data sets -----------------------------------------------------------------------------------------

@query
def training_set(spark, folder):
    """From stores that were laid out by customer beforehand: the join itself moves no row."""
    rows = dataset.training_set_in_place(_laid_out(spark, folder), TRAIN_DATE)
    return rounded(rows, "Loans_per_Credit_Item", "Debt_to_Salary")


def _laid_out(spark, folder):
    labels = write_and_reread(label_store_(spark, folder), "labels")
    return dataset.lay_out(spark, scratch_path(spark, "by-customer"), labels, stored_risk_store(spark, folder))


@query
def training_set_moved(spark, folder):
    """The same set by a join that places both sides itself."""
    rows = dataset.training_set(label_store_(spark, folder), stored_risk_store(spark, folder), TRAIN_DATE)
    return rounded(rows, "Loans_per_Credit_Item", "Debt_to_Salary")


@query
def cohort_in_place(spark, folder):
    """The cohort of a snapshot after a later part of the labels was added to the stores, dealt with hot customers cut small."""
    labels = write_and_reread(label_store_(spark, folder), "labels")
    old = F.col("snapshot_date") < SNAPSHOT
    stores = dataset.lay_out(spark, scratch_path(spark, "by-customer"), labels.filter(old), stored_risk_store(spark, folder), hot_rows=5)
    stores.add(labels.filter(~old), "left")
    return rounded(dataset.scoring_cohort_in_place(stores, SNAPSHOT), "Loans_per_Credit_Item", "Debt_to_Salary")


@query
def scoring_cohort(spark, folder):
    cohort = dataset.scoring_cohort(label_store_(spark, folder), stored_risk_store(spark, folder), SNAPSHOT)
    return rounded(cohort, "Loans_per_Credit_Item", "Debt_to_Salary")


@query
def feature_snapshot(spark, folder):
    raw = tables.one_snapshot(s.raw_financials(spark, folder), "2000-06-01")  # caps are taken per snapshot
    store = gold.risk_store(silver.financials(raw), silver.attributes(s.raw_attributes(spark, folder)))
    out = dataset.feature_snapshot(store, "2000-06-01").select("Customer_ID", *MODEL_FEATURES)
    return rounded(out, "Loans_per_Credit_Item", "Debt_to_Salary")


def labelled_orders(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.to_date("o_orderdate").alias("snapshot_date"), "o_totalprice", "o_custkey")


@query
def stratified_split(spark, folder):
    return stratify.stratified_split(labelled_orders(spark, folder), "label", ["o_orderkey"]).select(
        "o_orderkey", "label", "split")


@query
def stratified_folds(spark, folder):
    return stratify.stratified_folds(labelled_orders(spark, folder), "label", ["o_orderkey"]).select(
        "o_orderkey", "label", "fold")


@query
def split_counts(spark, folder):
    rows = dataset.with_split(labelled_orders(spark, folder), ["o_orderkey"], TRAIN_DATE)
    return ranking.positive_rate(rows, "label", ["split"])


@query
def standardise(spark, folder):
    measures = lineitem(spark, folder).select("l_orderkey", "l_linenumber", *MEASURES)
    return rounded(summary.standardise(measures, MEASURES, summary.scaling_moments(measures, MEASURES)), *MEASURES)


@query
def hot_key_join(spark, folder):
    """Few keys on the left, each with a large part of the rows on the right, and one without a match."""
    right = orders(spark, folder).select("o_orderstatus", "o_orderkey")
    left = right.select("o_orderstatus").distinct().unionByName(spark.range(1).select(F.lit("none").alias("o_orderstatus")))
    return left_join(left, right, "o_orderstatus")


# --- statistics ----------------------------------------------------------------------------------------

@query
def exact_deciles(spark, folder):
    q = exact_quantiles(lineitem(spark, folder), MEASURES, [i / 10 for i in range(11)])
    return rounded_array(q, "quantiles")


@query
def quantiles_by_status(spark, folder):
    q = exact_quantiles(orders(spark, folder), ["o_totalprice", "o_custkey"], [0.25, 0.5, 0.97],
                        by=["o_orderstatus"], method="disc")
    return rounded_array(q, "quantiles")


@query
def score_summary(spark, folder):
    documents = s.table(spark, folder, "documents")
    out = summary.score_summary(documents, "n_chars", ["lang"])
    return rounded(out, *[c for c in out.columns if c not in ("lang", "n")], places=4)


@query
def auc_gini(spark, folder):
    matched = s.table(spark, folder, "documents").join(s.table(spark, folder, "labels"), "doc_id")
    return rounded(ranking.auc_and_gini(matched, "n_chars", "quality"), "auc", "gini")


@query
def auc_by_split(spark, folder):
    rows = dataset.with_split(labelled_orders(spark, folder), ["o_orderkey"], TRAIN_DATE)
    out = scoring.split_performance(rows, "o_totalprice")
    return rounded(out, "auc")


@query
def auc_many_ties(spark, folder):
    rows = lineitem(spark, folder).select(
        "l_linestatus", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return rounded(ranking.roc_auc(rows, "l_quantity", "label", ["l_linestatus"]), "auc")


@query
def balanced_accuracy(spark, folder):
    rows = orders(spark, folder).select(
        "o_orderpriority", (F.col("o_totalprice") > 250000).cast("int").alias("prediction"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    out = ranking.balanced_accuracy(rows, "prediction", "label", ["o_orderpriority"])
    return rounded(out, "tpr", "tnr", "balanced_accuracy")


def _price_periods(spark, folder):
    return orders(spark, folder), F.year("o_orderdate") < 1999


@query
def psi_two_sample(spark, folder):
    df, is_base = _price_periods(spark, folder)
    psi = stability.psi_two_sample(df, ["o_totalprice"], is_base)
    return rounded(rounded_array(psi, "edges", places=4), "psi", places=8)


@query
def psi_equal_width(spark, folder):
    df, is_base = _price_periods(spark, folder)
    psi = stability.psi_two_sample(df, ["o_totalprice", "o_custkey"], is_base, use_quantiles=False)
    return rounded(psi.drop("edges"), "psi", places=8)


def _measure_periods():
    return F.year("l_shipdate") < 1998


@query
def csi_features(spark, folder):
    psi = stability.psi_two_sample(lineitem(spark, folder), MEASURES, _measure_periods())
    return rounded(psi.drop("edges"), "psi", places=8)


@query
def csi_summary(spark, folder):
    psi = stability.psi_two_sample(lineitem(spark, folder), MEASURES, _measure_periods())
    return rounded(stability.csi_summary(psi), "csi_mean", "csi_max", places=8)


@query
def psi_train_oot(spark, folder):
    rows = dataset.with_split(labelled_orders(spark, folder), ["o_orderkey"], TRAIN_DATE)
    stored = write_and_reread(rows.select("split", "o_totalprice", "o_custkey"), "scored")
    out = scoring.split_stability(stored, ["o_custkey"], score_col="o_totalprice")
    return rounded(out, "psi_score", "csi_mean", "csi_max", places=8)


@query
def psi_tied_scores(spark, folder):
    """Scores of few values: where deciles tie, edges are taken again for as many bins as were left."""
    rows = dataset.with_split(labelled_orders(spark, folder), ["o_orderkey"], TRAIN_DATE)
    tied = write_and_reread(rows.select("split", (F.floor(F.col("o_totalprice") / 90000)).alias("score"), "o_custkey"), "scored")
    out = scoring.split_stability(tied, ["o_custkey"], score_col="score")
    return rounded(out, "psi_score", "csi_mean", "csi_max", places=8)


def _baseline(spark, folder):
    before = s.scored(spark, folder).filter(F.col("snapshot_date") < "1998-01-01")
    return stability.monitoring_baseline(before, s.SCORED_FEATURES)


def _drift(spark, folder):
    since = s.scored(spark, folder).filter(F.col("snapshot_date") >= "1998-01-01")
    return monitoring.drift_records(since, s.SCORED_FEATURES, _baseline(spark, folder))


@query
def baseline_table(spark, folder):
    return rounded_array(rounded_array(_baseline(spark, folder), "edges", places=4), "expected")


@query
def psi_vs_baseline(spark, folder):
    since = s.scored(spark, folder).filter(F.col("snapshot_date") >= "1998-01-01")
    psi = stability.psi_against_baseline(
        since, ["score", *s.SCORED_FEATURES], _baseline(spark, folder), monitoring.KEYS)
    return rounded(psi, "psi")


@query
def baseline_per_model(spark, folder):
    rows = s.scored(spark, folder)
    before, since = (rows.filter(f"snapshot_date {op} '1998-01-01'") for op in ("<", ">="))
    baseline = stability.monitoring_baseline(before, s.SCORED_FEATURES, by=["model_id"])
    psi = stability.psi_against_baseline(
        since, ["score", *s.SCORED_FEATURES], baseline, ["model_id"], ["model_id"])
    return rounded(psi, "psi")


def _stored_state(spark, folder, baseline, by_model=False):
    """The counts of every scored snapshot, as scoring leaves them behind: published per model and snapshot."""
    path, keys = scratch_path(spark, "bin-counts"), ["model_id"] if by_model else []
    versions.publish(
        monitoring.scored_state(s.scored(spark, folder), s.SCORED_FEATURES, baseline, baseline_by=keys), path, monitoring.BY_MODEL)
    return tables.read_snapshots(spark, path)


def _since(state):
    return state.filter(F.col("snapshot_date") >= "1998-01-01")


@query
def bin_state(spark, folder):
    return _stored_state(spark, folder, _baseline(spark, folder)).drop("edges_id")


@query
def drift_from_state(spark, folder):
    """Drift of every quarter and year from stored counts."""
    baseline = stored(_baseline(spark, folder))
    state = _since(_stored_state(spark, folder, baseline))
    spans = dates.calendar_spans(spark, "1998-01-01", "2001-12-31", "quarter").unionByName(
        dates.calendar_spans(spark, "1998-01-01", "2001-12-31", "year"))
    return rounded(monitoring.span_drift(state, spans, baseline), "psi_score", "csi_mean", "csi_max")


@query
def baseline_json(spark, folder):
    """The baseline written as the JSON object beside a model and read back."""
    path = scratch_path(spark, "bins")
    baseline = stored(_baseline(spark, folder))
    sinks.write_baseline_json(baseline, ["model_id", *s.SCORED_FEATURES], s.SCORED_FEATURES, path)
    back = tables.read_baseline_json(spark, path).drop("source")
    return rounded_array(rounded_array(back, "edges", places=4), "expected")


@query
def baseline_stored(spark, folder):
    """Baselines of two models, each written into its own partition, one of them twice."""
    path = scratch_path(spark, "baseline")
    before = s.scored(spark, folder).filter(F.col("snapshot_date") < "1998-01-01")
    rows = stored(stability.monitoring_baseline(before, s.SCORED_FEATURES, by=["model_id"]))
    sinks.write_snapshots(rows, path, by=("model_id",))
    sinks.write_snapshots(rows.filter("model_id = 'model_F'"), path, by=("model_id",))
    return rounded_array(rounded_array(tables.read_snapshots(spark, path), "edges", places=4), "expected")


@query
def records_from_state(spark, folder):
    """The drift record of every snapshot and model from stored counts."""
    baseline = stored(_baseline(spark, folder))
    state = _since(_stored_state(spark, folder, baseline))
    return rounded(monitoring.drift_from_state(state, baseline), "psi_score", "csi_max")


@query
def state_per_model(spark, folder):
    """Index of all later rows against the baseline of each model, and how many lie off its edges."""
    rows = s.scored(spark, folder)
    before = rows.filter("snapshot_date < '1998-01-01'")
    baseline = stored(stability.monitoring_baseline(before, s.SCORED_FEATURES, by=["model_id"]))
    state = bins.merged(_since(_stored_state(spark, folder, baseline, by_model=True)), ["model_id"])
    return rounded(bins.psi_of_state(state, baseline, ["model_id"], ["model_id"]), "psi")


@query
def baseline_of_state(spark, folder):
    """A new baseline: the stored edges with the shares of a later year, from its counts."""
    baseline = stored(_baseline(spark, folder))
    year = _stored_state(spark, folder, baseline).filter(F.year("snapshot_date") == 1998)
    return rounded_array(rounded_array(bins.baseline_of_state(year, baseline), "edges", places=4), "expected")


# --- monitoring ----------------------------------------------------------------------------------------

@query
def drift_flags(spark, folder):
    return rounded(_drift(spark, folder), "psi_score", "csi_max")


@query
def drift_record_json(spark, folder):
    path = scratch_path(spark, "drift")
    sinks.write_drift(rounded(_drift(spark, folder), "psi_score", "csi_max"), path)
    return tables.read_drift(spark, path)


@query
def drift_decision(spark, folder):
    records = _drift(spark, folder).withColumn("written_at", F.lit("2002-01-01").cast("timestamp"))
    limits = records.withColumn("psi_threshold", F.lit(0.02))
    runs = dates.month_calendar(spark, *PANEL)
    return decisions.drift_decision(limits, runs)


@query
def newest_predictions(spark, folder):
    picked = decisions.newest_predictions(s.predictions(spark, folder))
    return picked.groupBy("snapshot_date", "model_id").agg(F.count("*").alias("rows"))


@query
def perf_breach(spark, folder):
    records = monitoring.performance_records(s.predictions(spark, folder), s.order_labels(spark, folder))
    return rounded(records, "auc", "gini")


@query
def prediction_store(spark, folder):
    path = scratch_path(spark, "predictions")
    digits = F.replace("model_id", F.lit("model_"), F.lit("00"))
    sinks.write_predictions(s.predictions(spark, folder).withColumn("model_id", digits), path)
    return tables.read_snapshots(spark, path)


@query
def any_known(spark, folder):
    return decisions.any_known(s.order_labels(spark, folder), "label")


@query
def metric_json(spark, folder):
    events = s.table(spark, folder, "events")
    parsed = F.from_json("props", "k int, missing double")
    return events.select(
        "event_id", parsed["k"].alias("k"), F.coalesce(parsed["missing"], F.lit(0.25)).alias("threshold"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("record"))


@query
def record_json(spark, folder):
    """Performance records as flat JSON objects."""
    records = monitoring.performance_records(s.predictions(spark, folder), s.order_labels(spark, folder))
    return monitoring.record_json(records, ["model_id", "n_pos", "n_neg", "auc_breach", "gini_breach", "breach", "decision"])


@query
def metrics_last_wins(spark, folder):
    samples = s.table(spark, folder, "events").select(
        F.col("event_type").alias("metric"), F.to_date("ts").alias("snapshot_date"),
        (F.col("user_id") % 5).alias("model_id"), "value", F.col("ts").cast("timestamp").alias("logged_at"), "event_id")
    return sinks.latest_metrics(samples, tiebreak="event_id")


@query
def metrics_compacted(spark, folder):
    """The last samples of a log that grew in four parts and was merged twice up to a watermark."""
    samples = s.table(spark, folder, "events").select(
        F.col("event_type").alias("metric"), F.to_date("ts").alias("snapshot_date"),
        (F.col("user_id") % 5).cast("string").alias("model_id"), "value", F.col("ts").cast("timestamp").alias("logged_at"), "event_id")
    log = metric_log.MetricLog(spark, scratch_path(spark, "metrics"), "event_id", f"{METRIC_SCHEMA}, event_id long")
    quarter = F.col("event_id") % 4
    for part in (2, 0):  # not in the order of time
        log.append(samples.filter(quarter == part))
    log.merge()
    log.append(samples.filter(quarter == 1))
    log.merge("2100-01-01")
    log.append(samples.filter(quarter == 3))
    return log.latest()


@query
def gauge_rows(spark, folder):
    records = monitoring.performance_records(s.predictions(spark, folder), s.order_labels(spark, folder))
    return rounded(monitoring.performance_metrics(records, F.col("snapshot_date").cast("timestamp")), "value").drop(
        "logged_at")


def _runs(spark, folder):
    return orders(spark, folder).select(F.trunc("o_orderdate", "MM").alias("run_date")).distinct()


@query
def train_gate(spark, folder):
    labels = lineitem(spark, folder).select(F.to_date("l_shipdate").alias("snapshot_date"))
    return decisions.training_gate(_runs(spark, folder), labels)


@query
def infer_gate(spark, folder):
    features = orders(spark, folder).select(F.to_date("o_orderdate").alias("snapshot_date"))
    return decisions.inference_gate(_runs(spark, folder), features, _resolved(spark, folder))


@query
def infer_gate_without_model(spark, folder):
    """No version of the name is registered and no file was saved before the tables begin."""
    features = orders(spark, folder).select(F.to_date("o_orderdate").alias("snapshot_date"))
    nothing = _resolved(spark, folder, name="none", as_of=F.lit("1990-01-01").cast("timestamp"))
    return decisions.inference_gate(_runs(spark, folder), features, nothing)


def _registry(spark, folder):
    part = s.table(spark, folder, "part")
    return part.select(
        F.col("p_brand").alias("name"), F.col("p_partkey").alias("version"),
        F.expr("timestamp '1999-01-01' + make_dt_interval(p_size, p_partkey % 24)").alias("last_updated"))


def _files(spark, folder):
    return s.table(spark, folder, "supplier").select(
        F.concat(F.lit("credit_model_"), F.col("s_suppkey").cast("string"), F.lit(".pkl")).alias("file"),
        F.expr("timestamp '1999-01-01' + make_dt_interval(s_nationkey)").alias("modified"))


def _resolved(spark, folder, name="Brand#1", as_of=None):
    return decisions.resolve_model(_registry(spark, folder), _files(spark, folder), name, as_of)


@query
def latest_model(spark, folder):
    as_of = F.lit("1999-01-20").cast("timestamp")
    return (
        _resolved(spark, folder).unionByName(_resolved(spark, folder, as_of=as_of))
        .unionByName(_resolved(spark, folder, name="none"))
    )


@query
def missing_snapshots(spark, folder):
    present = orders(spark, folder).select(F.trunc("o_orderdate", "MM").alias("snapshot_date")).distinct()
    return decisions.missing_snapshots(dates.month_calendar(spark, "1994-06-15", "2002-03-01"), present)


@query
def not_yet_trained(spark, folder):
    done = lineitem(spark, folder).filter(F.col("l_shipdate") < "1999-01-01").select(
        F.trunc("l_shipdate", "MM").alias("run_date")).distinct()
    return decisions.not_yet_run(_runs(spark, folder), done)


# --- profile -------------------------------------------------------------------------------------------

@query
def profile_nulls(spark, folder):
    return summary.column_counts(risk_store_(spark, folder))


@query
def feature_list(spark, folder):
    """Features by exclusion of the id columns, told numeric or not, each with what is known of it."""
    rows = write_and_reread(silver.attributes(s.raw_attributes(spark, folder)), "attributes")
    features = summary.feature_columns(rows, ID_COLUMNS)
    numeric, other = summary.numeric_columns(rows.select(*features)), summary.other_columns(rows.select(*features))
    means = rows.select(*[F.avg(c).alias(c) for c in numeric]).unpivot([], numeric, "column", "mean")
    values = rows.select(*[F.count_distinct(c).alias(c) for c in other]).unpivot([], other, "column", "n_values")
    listed = summary.column_counts(rows, features).join(means, "column", "left").join(values, "column", "left")
    return rounded(listed.select("column", F.col("column").isin(numeric).alias("is_numeric"), "n_known", "mean", "n_values"), "mean")


@query
def profile_unique(spark, folder):
    return summary.uniqueness(s.raw_financials(spark, folder), "Customer_ID")


@query
def profile_top(spark, folder):
    values = silver.financial_values(s.raw_financials(spark, folder))
    return summary.top_values(values, "Num_of_Delayed_Payment")


@query
def profile_frequent(spark, folder):
    """The 25 most frequent customers of orders, with ties, from bounded candidates."""
    return summary.frequent_values(orders(spark, folder), "o_custkey")


@query
def profile_frequent_text(spark, folder):
    """The 25 most frequent labels of parts in line items, NULL among them."""
    label = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
    return summary.frequent_values(write_and_reread(lineitem(spark, folder).select(label.alias("label")), "labels"), "label", tracked=512)


def _customer_bitmaps(spark, folder):
    """Customers per month, added in two batches of years, one month a second time."""
    seen = orders(spark, folder).select("o_custkey", F.trunc("o_orderdate", "MM").alias("snapshot_date"))
    store = distinct.DistinctStore(spark, scratch_path(spark, "distinct"), "o_custkey")
    early = F.col("snapshot_date") < "1998-01-01"
    store.add(seen.filter(early), "1990-01-01", "1997-12-31")
    store.add(seen.filter(~early), "1998-01-01", "2010-12-31")
    store.add(tables.one_snapshot(seen, "1999-03-01"))
    return store


@query
def cumulative_customers(spark, folder):
    """Customers of each month, new ones and all so far, exact, from bitmaps."""
    return _customer_bitmaps(spark, folder).cumulative()


@query
def customers_of_spans(spark, folder):
    """Distinct customers of every quarter and year from the bitmaps of their months."""
    spans = dates.calendar_spans(spark, *s.ALL_DATES, "quarter").unionByName(dates.calendar_spans(spark, *s.ALL_DATES, "year"))
    return _customer_bitmaps(spark, folder).over_spans(spans)


@query
def profile_hist(spark, folder):
    return rounded(stability.even_histogram(lineitem(spark, folder), MEASURES), "bin_low", "bin_high")


@query
def profile_first(spark, folder):
    rows = silver.financial_values(s.raw_financials(spark, folder)).select("Customer_ID", "record_id", "Credit_Mix")
    return summary.first_rows(rows, ["Customer_ID", "record_id"])


@query
def profile_missing(spark, folder):
    rows = silver.attributes(s.raw_attributes(spark, folder))
    return summary.first_rows(summary.rows_missing(rows, "Age"), ["Customer_ID"], 20)


@query
def profile_first_date(spark, folder):
    return label_store_(spark, folder).agg(F.min("snapshot_date").alias("first_date"), F.count("*").alias("rows"))


# --- models ---------------------------------------------------------------------------------------------

def _stump_rows(spark, folder):
    """Line items with a label and two features of few values, one of them with missing values."""
    return write_and_reread(lineitem(spark, folder).select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), "l_quantity",
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"), (F.col("l_orderkey") % 3).cast("int").alias("fold"),
        (F.col("l_extendedprice") > 40000).cast("int").alias("label")), "stump")


STUMP = {"maxIter": 1, "maxDepth": 1, "maxBins": 64}
STUMP_FEATURES = ["l_discount", "l_quantity"]


@query
def ml_stump(spark, folder):
    """A single split fitted on the lines before a date; every line is scored."""
    rows = _stump_rows(spark, folder)
    model = scoring.fit(rows.filter(F.col("day") < "1999-01-01"), STUMP_FEATURES, **STUMP)
    return rounded(scoring.score(model, rows).select("l_orderkey", "l_linenumber", "model_predictions"), "model_predictions")


@query
def stump_search(spark, folder):
    """Two settings over three folds: one that splits and one that asks for more than a split can gain."""
    rows = _stump_rows(spark, folder)
    space = {**{k: [v] for k, v in STUMP.items()}, "minInfoGain": [0.0, 0.9]}
    model, found, accuracy = scoring.search(rows, STUMP_FEATURES, draws=2, space=space)
    scores = rounded(scoring.score(model, rows), "model_predictions").groupBy("model_predictions").agg(F.count("*").alias("rows"))
    return scores.withColumns({
        "min_info_gain": F.lit(float(found["minInfoGain"])), "balanced_accuracy": F.round(F.lit(float(accuracy)), 6)})


# (tree, weight, node, feature, threshold, left, right, value): two trees of depth three
TREES = [
    (0, 1.0, 0, "l_quantity", 24.0, 1, 8, 0.0), (0, 1.0, 1, "l_discount", 0.03, 2, 5, 0.0), (0, 1.0, 2, "l_tax", 0.02, 3, 4, 0.0),
    (0, 1.0, 3, None, None, None, None, -0.75), (0, 1.0, 4, None, None, None, None, -0.25), (0, 1.0, 5, "l_extendedprice", 20000.0, 6, 7, 0.0),
    (0, 1.0, 6, None, None, None, None, 0.125), (0, 1.0, 7, None, None, None, None, 0.5), (0, 1.0, 8, "l_extendedprice", 45000.0, 9, 12, 0.0),
    (0, 1.0, 9, "l_discount", 0.06, 10, 11, 0.0), (0, 1.0, 10, None, None, None, None, 0.25), (0, 1.0, 11, None, None, None, None, 0.375),
    (0, 1.0, 12, None, None, None, None, 1.0),
    (1, 0.5, 0, "l_discount", 0.05, 1, 4, 0.0), (1, 0.5, 1, "l_quantity", 10.0, 2, 3, 0.0), (1, 0.5, 2, None, None, None, None, -1.0),
    (1, 0.5, 3, None, None, None, None, 0.0625), (1, 0.5, 4, "l_tax", 0.04, 5, 8, 0.0), (1, 0.5, 5, "l_quantity", 40.0, 6, 7, 0.0),
    (1, 0.5, 6, None, None, None, None, 0.5), (1, 0.5, 7, None, None, None, None, -0.5), (1, 0.5, 8, None, None, None, None, 0.75),
]


@query
def tree_scores(spark, folder):
    """Every line item scored by a table of nodes; a missing discount goes right."""
    nodes = spark.createDataFrame(
        TREES, "tree int, weight double, node int, feature string, threshold double, left int, right int, value double")
    rows = lineitem(spark, folder).select(
        "l_orderkey", "l_linenumber", *[c for c in MEASURES if c != "l_discount"],
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"))
    return rounded(trees.score(nodes, rows).select("l_orderkey", "l_linenumber", "model_predictions"), "model_predictions", places=9)


# --- models of many trees (no SQL) --------------------------------------------------------------------

def _model_rows(spark, folder):
    """Training rows keyed by their content; joined rows and split rows are stored, as splitting and fitting pass over them many times."""
    rows = dataset.training_set(label_store_(spark, folder), stored_risk_store(spark, folder), TRAIN_DATE)
    keyed = rows.withColumn("row_key", F.sha2(F.to_json(F.struct("*")), 256))
    keyed = write_and_reread(keyed, "keyed")
    return write_and_reread(dataset.with_split(keyed, ["row_key"], TRAIN_DATE), "training")


@query
def ml_scores(spark, folder):
    rows = _model_rows(spark, folder)
    model = scoring.fit(rows.filter("split = 'train'"), MODEL_FEATURES, maxIter=5, maxDepth=3)
    scored = scoring.score(model, rows).select("split", "label", "model_predictions", *MODEL_FEATURES)
    scored = write_and_reread(scored, "scored")
    performance = scoring.split_performance(scored)
    stability_ = scoring.split_stability(scored, MODEL_FEATURES)
    return performance.join(stability_, performance["split"] == stability_["compared"], "left").drop("compared")


@query
def model_search(spark, folder):
    rows = _model_rows(spark, folder)
    train = write_and_reread(dataset.with_folds(rows.filter("split = 'train'"), ["row_key"]), "folds")
    space = {"maxIter": [2, 4], "maxDepth": [2, 3], "stepSize": [0.1, 1.0]}
    model, _, _ = scoring.search(train, MODEL_FEATURES, draws=2, space=space)
    test = scoring.score(model, rows.filter("split = 'test'"))
    hard = test.withColumn("prediction", (F.col("model_predictions") > 0.5).cast("int"))
    return ranking.balanced_accuracy(hard, "prediction", "label")
