"""SQL for the queries, written against the test tables for an independent engine."""

from __future__ import annotations

from tidemark.workload import standins as s

SQL: dict[str, str] = {}

TRAIN_DATE = "2000-09-01"
SNAPSHOT = "2000-06-15"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DECILES = "[0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]"
RISK = """ "Customer_ID", "Credit_History_Age", round("Loans_per_Credit_Item", 6) + 0.0 AS "Loans_per_Credit_Item",
  round("Debt_to_Salary", 6) + 0.0 AS "Debt_to_Salary", "Loan_Extent", "Outstanding_Debt", "Interest_Rate",
  "Delay_from_due_date", "Changed_Credit_Limit", "Payment_Behaviour", "Age", "Occupation" """


def sql(name: str, body: str, *ctes: str) -> None:
    head = "WITH " + ",\n".join(c.strip() for c in ctes if c) + "\n" if ctes else ""
    SQL[f"q_{name}"] = head + body.strip()


def fixed(c: str, places: int = 6) -> str:
    return f"array_to_string(list_transform({c}, lambda x: CAST(CAST(round(x, {places}) AS DECIMAL(30,{places})) AS VARCHAR)), ',')"


# --- sources and layers --------------------------------------------------------------------------------

sql("bronze_snapshot", f"""
SELECT * REPLACE (CAST(snapshot_date AS DATE) AS snapshot_date) FROM raw_loans
WHERE CAST(snapshot_date AS DATE) = DATE '{SNAPSHOT}'""", s.RAW_LOANS)

sql("bronze_range", """
SELECT CAST(snapshot_date AS DATE) AS snapshot_date, count(*) AS rows FROM raw_loans
WHERE snapshot_date BETWEEN '2000-06-01' AND '2000-06-30' GROUP BY 1""", s.RAW_LOANS)

sql("bronze_sources", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS source, CAST(snapshot_date AS DATE) AS snapshot_date, count(*) AS rows "
    f"FROM raw_{name if name != 'clickstream' else 'clicks'} GROUP BY 2"
    for name in ("loans", "clickstream", "attributes", "financials")),
    s.RAW_LOANS, s.RAW_CLICKS, s.RAW_ATTRIBUTES, s.RAW_FINANCIALS)

sql("raw_csv", """SELECT * REPLACE (CAST(snapshot_date AS DATE) AS snapshot_date) FROM silver_attributes""",
    s.SILVER_ATTRIBUTES)

# A raw file holds text alone, and an empty text comes back as a missing one.
for _source, _raw in (
        ("loans", s.RAW_LOANS), ("clickstream", s.RAW_CLICKS), ("attributes", s.RAW_ATTRIBUTES), ("financials", s.RAW_FINANCIALS)):
    _table = f"raw_{_source if _source != 'clickstream' else 'clicks'}"
    sql(f"bronze_{_source}_csv", f"""
SELECT nullif(CAST(COLUMNS(* EXCLUDE (snapshot_date)) AS VARCHAR), ''), CAST(snapshot_date AS DATE) AS snapshot_date FROM {_table}""", _raw)

sql("snapshot_rewrite", """
SELECT event_id, "Customer_ID", CASE WHEN snapshot_date = DATE '1999-03-01' THEN -1 ELSE fe_1 END AS fe_1, snapshot_date
FROM silver_clicks WHERE snapshot_date <> DATE '1999-05-01'""", s.SILVER_CLICKS)

sql("snapshot_versions", """
SELECT 1 AS manifest, snapshot_date, count(*) AS rows, min(fe_1) AS least FROM silver_clicks GROUP BY 2
UNION ALL
SELECT n, snapshot_date, count(*), CASE WHEN snapshot_date = DATE '1999-03-01' THEN -1 ELSE min(fe_1) END
FROM silver_clicks, (VALUES (2), (3)) m(n)
WHERE n = 2 OR snapshot_date = DATE '1999-05-01' OR snapshot_date NOT BETWEEN DATE '1999-04-01' AND DATE '2000-02-01'
GROUP BY 1, 2""", s.SILVER_CLICKS)

sql("absent_sources", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS source, {n} AS columns, count(*) AS rows, count(*) AS dated FROM raw_{table}"
    for name, table, n in (("loans", "loans", 11), ("clickstream", "clicks", 22), ("attributes", "attributes", 6),
                           ("financials", "financials", 21))),
    s.RAW_LOANS, s.RAW_CLICKS, s.RAW_ATTRIBUTES, s.RAW_FINANCIALS)

sql("snapshot_catalogue", """
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
WHERE o_orderdate <= DATE '2000-06-15'""")

sql("snapshot_in_file_name", """
SELECT CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS snapshot_date, count(*) AS files
FROM orders GROUP BY 1""")

sql("schema_enforce", """
SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num,
  """ + ", ".join(f"round(CAST({c} AS DOUBLE), 2) + 0.0 AS {c}"
                  for c in ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")) + """, snapshot_date
FROM typed_loans""", s.SILVER_LOANS)

sql("clickstream_silver", "SELECT * FROM silver_clicks", s.SILVER_CLICKS)

sql("loan_dpd", """
SELECT loan_id, "Customer_ID", mob, installments_missed, first_missed_date, dpd, snapshot_date
FROM silver_loans""", s.SILVER_LOANS)

sql("attr_clean", "SELECT * FROM silver_attributes", s.SILVER_ATTRIBUTES)

_MONEY = [*s._MONEY, "Changed_Credit_Limit", "Credit_Utilization_Ratio"]
sql("currency_clean", "SELECT record_id, " + ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in _MONEY) + ", "
    + ", ".join(f'"{c}"' for c in s._COUNTS) + " FROM clean_financials", s.CLEAN_FINANCIALS)

sql("currency_signed", """
SELECT o_orderkey AS record_id,
  CAST(NULL AS DOUBLE) AS balance_null,
  -round(CAST(o_custkey % 700 AS DOUBLE) + 0.125, 3) AS balance_keep,
  CAST(CASE WHEN o_custkey % 60 >= 5 THEN o_custkey % 60 - 5 END AS INTEGER) AS delay_null,
  CAST(o_custkey % 60 - 5 AS INTEGER) AS delay_keep
FROM orders""")

sql("history_months", 'SELECT record_id, "Credit_History_Age" AS months FROM clean_financials', s.CLEAN_FINANCIALS)

sql("encode_ordinal", """
SELECT record_id, c."Credit_Mix", CASE WHEN r."Credit_Mix" IN ('Bad', 'Standard', 'Good') THEN r."Credit_Mix" END
  AS "Credit_Mix_text", c."Payment_of_Min_Amount", c."Payment_Behaviour"
FROM clean_financials c JOIN raw_financials r USING (record_id)""", s.CLEAN_FINANCIALS)

sql("p97_cap", """
SELECT o_orderkey, snapshot_date,
  CASE WHEN o_totalprice > p THEN p ELSE o_totalprice END AS o_totalprice,
  CAST(CASE WHEN o_custkey > k THEN k ELSE o_custkey END AS DOUBLE) AS o_custkey
FROM m JOIN (SELECT snapshot_date, quantile_disc(o_totalprice, 0.97) AS p, quantile_disc(o_custkey, 0.97) AS k
             FROM m GROUP BY snapshot_date) USING (snapshot_date)""",
    "m AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)")

_ORDER_MONTHS = """
m AS (
  SELECT feature, snapshot_date, value FROM (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey
    FROM orders) UNPIVOT (value FOR feature IN (o_totalprice, o_custkey)))"""
sql("sketch_caps", """
SELECT span, first, last, feature, count(*) AS n, count(*) AS sketched, true AS near FROM (
  SELECT 'quarter' AS span, CAST(date_trunc('quarter', snapshot_date) AS DATE) AS first,
    CAST(date_trunc('quarter', snapshot_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last, feature FROM m
  UNION ALL
  SELECT 'year', CAST(date_trunc('year', snapshot_date) AS DATE),
    CAST(date_trunc('year', snapshot_date) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE), feature FROM m)
GROUP BY ALL""", _ORDER_MONTHS)

sql("sketch_capped", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, count(*) AS n, true AS o_totalprice_near,
  true AS o_custkey_near, true AS o_totalprice_held, true AS o_custkey_held FROM orders GROUP BY 1""")

sql("cap_approximate", """
SELECT snapshot_date, feature, count(*) AS n, true AS near
FROM (SELECT snapshot_date, """ + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in s._CAPPED) + """ FROM clean_financials)
  UNPIVOT (value FOR feature IN (""" + ", ".join(f'"{c}"' for c in s._CAPPED) + """)) GROUP BY 1, 2""", s.CLEAN_FINANCIALS)

sql("fin_features", 'SELECT record_id, "Customer_ID", snapshot_date, ' + ", ".join(f'"{c}"' for c in s._CAPPED) + """,
  "Credit_Mix", "Payment_of_Min_Amount", "Credit_History_Age",
  round("Loans_per_Credit_Item", 6) + 0.0 AS "Loans_per_Credit_Item",
  round("Debt_to_Salary", 6) + 0.0 AS "Debt_to_Salary", "Loan_Extent" FROM silver_financials""", s.SILVER_FINANCIALS)

sql("label_store", "SELECT * FROM label_store", s.LABEL_STORE)

sql("default_rate", """
SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, count(*) AS n,
  round(avg(label), 4) + 0.0 AS positive_rate FROM label_store GROUP BY 1""", s.LABEL_STORE)

_PANEL = s.SILVER_CLICKS + """,
monthly AS (
  SELECT "Customer_ID", snapshot_date AS month, first(fe_1 ORDER BY event_id) AS fe_1
  FROM silver_clicks GROUP BY 1, 2),
served AS (
  SELECT "Customer_ID", CAST(month + to_months(CAST(i AS INTEGER)) AS DATE) AS snapshot_date, i, fe_1
  FROM monthly, range(1, 7) t(i)),
panel AS (
  SELECT "Customer_ID", snapshot_date, """ + ", ".join(
    f"min(CASE WHEN i = {i} THEN fe_1 END) AS click_{i}m" for i in range(1, 7)) + """
  FROM served WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' GROUP BY 1, 2)"""
_SCAFFOLD = """
scaffold AS (
  SELECT DISTINCT "Customer_ID", snapshot_date, """ + ", ".join(
    f"CAST(NULL AS INTEGER) AS click_{i}m" for i in range(1, 7)) + """
  FROM silver_clicks c
  WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'
    AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT snapshot_date AS d FROM silver_clicks)
                    WHERE d < c.snapshot_date AND d >= c.snapshot_date - to_months(6)))"""

sql("engagement_pivot", "SELECT * FROM panel", _PANEL)
sql("engagement_scaffold", "SELECT * FROM scaffold", s.SILVER_CLICKS, _SCAFFOLD)
sql("engagement_store", "SELECT * FROM panel UNION ALL BY NAME SELECT * FROM scaffold", _PANEL, _SCAFFOLD)

SQL["q_engagement_carried"], SQL["q_engagement_late_month"] = SQL["q_engagement_store"], SQL["q_engagement_pivot"]
sql("engagement_by_value", "SELECT * FROM panel UNION ALL BY NAME SELECT * FROM scaffold",
    _PANEL.replace("first(fe_1 ORDER BY event_id)", "min(fe_1)"), _SCAFFOLD)

sql("daily_panel", """
SELECT user_id, CAST(day + to_days(CAST(i AS INTEGER)) AS DATE) AS day,
  """ + ", ".join(f"CAST(min(CASE WHEN i = {i} THEN n END) AS INTEGER) AS events_{i}d" for i in range(1, 7)) + """
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2), range(1, 7) t(i)
GROUP BY 1, 2""")

sql("risk_store", f"SELECT {RISK}, snapshot_date FROM risk_store", s.RISK_STORE)

# --- calendar and text ---------------------------------------------------------------------------------

sql("month_calendar", """
SELECT CAST(d AS DATE) AS snapshot_date, month(d) IN (3, 6, 9, 12) AS quarter, strftime(d, '%Y_%m_%d') AS suffix
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS d
      FROM orders)""")

sql("window_dates", """
SELECT d AS train_date,
  CAST(CAST(d - INTERVAL 2 MONTH AS DATE) - INTERVAL 12 MONTH AS DATE) AS train_test_start,
  CAST(CAST(d - INTERVAL 2 MONTH AS DATE) - INTERVAL 1 DAY AS DATE) AS train_test_end,
  CAST(d - INTERVAL 2 MONTH AS DATE) AS oot_start, CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")

sql("model_addresses", """
SELECT 'models:/risk_tree/' || last AS uri, 'risk_tree' AS model_name, TRY_CAST(last AS INTEGER) AS model_version,
  CASE WHEN last = 'Production' THEN last END AS model_stage, 'risk_tree_' || last AS model_id
FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'Production' ELSE CAST(o_orderkey AS VARCHAR) END AS last FROM orders)
UNION ALL
SELECT 'credit_model_' || CAST(o_orderkey AS VARCHAR) || '.pkl', NULL, NULL, NULL,
  'credit_model_' || CAST(o_orderkey AS VARCHAR) FROM orders""")

# --- data sets -----------------------------------------------------------------------------------------

_BOTH = s.LABEL_STORE + "," + s.RISK_STORE
sql("training_set", f"""
SELECT loan_id, label, label_def, l.snapshot_date,
  CASE WHEN l.snapshot_date >= DATE '2000-07-01' THEN 'oot' ELSE 'train_test' END AS period,
  {RISK.replace('"Customer_ID"', 'l."Customer_ID"')}
FROM label_store l LEFT JOIN risk_store r ON l."Customer_ID" = r."Customer_ID"
WHERE l.snapshot_date BETWEEN DATE '1999-07-01' AND DATE '2000-08-31'""", _BOTH)

SQL["q_training_set_moved"] = SQL["q_training_set"]

sql("scoring_cohort", f"""
SELECT l.snapshot_date, {RISK.replace('"Customer_ID"', 'l."Customer_ID"')}
FROM label_store l LEFT JOIN risk_store r ON l."Customer_ID" = r."Customer_ID"
WHERE l.snapshot_date = DATE '{SNAPSHOT}'""", _BOTH)

SQL["q_cohort_in_place"] = SQL["q_scoring_cohort"]

sql("feature_snapshot", f"SELECT {RISK} FROM risk_store WHERE snapshot_date = DATE '2000-06-01'", s.RISK_STORE)

_LABELLED = """
labelled AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label, CAST(o_orderdate AS DATE) AS snapshot_date,
                    o_totalprice, o_custkey FROM orders)"""
_HASH = "md5('42|' || CAST(o_orderkey AS VARCHAR))"
_RANKED = f"""row_number() OVER (PARTITION BY label ORDER BY {_HASH}, CAST(o_orderkey AS VARCHAR)) AS rn,
  count(*) OVER (PARTITION BY label) AS n"""

sql("stratified_split", f"""
SELECT o_orderkey, label, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, {_RANKED} FROM labelled)""", _LABELLED)

sql("stratified_folds", f"""
SELECT o_orderkey, label,
  CAST(ntile(3) OVER (PARTITION BY label ORDER BY {_HASH}, CAST(o_orderkey AS VARCHAR)) - 1 AS INTEGER) AS fold
FROM labelled""", _LABELLED)

_SPLIT = _LABELLED + f""",
with_split AS (
  SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, {_RANKED} FROM labelled WHERE snapshot_date BETWEEN DATE '1999-07-01' AND DATE '2000-06-30')
  UNION ALL
  SELECT *, 'oot' FROM labelled WHERE snapshot_date BETWEEN DATE '2000-07-01' AND DATE '2000-08-31')"""

sql("split_counts", """
SELECT split, count(*) AS n, round(avg(label), 2) + 0.0 AS positive_rate FROM with_split GROUP BY split""", _SPLIT)

sql("standardise", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in MEASURES) + " FROM lineitem")

# --- statistics ----------------------------------------------------------------------------------------


def long(table: str, columns, keys=(), where: str = "true") -> str:
    k = "".join(f"{key}, " for key in keys)
    return " UNION ALL ".join(
        f"SELECT {k}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {table} WHERE {where}" for c in columns)


sql("exact_deciles", f"""
SELECT feature, count(*) AS n, {fixed(f'quantile_cont(value, {DECILES})')} AS quantiles
FROM ({long('lineitem', MEASURES)}) GROUP BY feature""")

sql("quantiles_by_status", f"""
SELECT o_orderstatus, feature, count(*) AS n, {fixed('quantile_disc(value, [0.25, 0.5, 0.97])')} AS quantiles
FROM ({long('orders', ['o_totalprice', 'o_custkey'], ['o_orderstatus'])}) GROUP BY o_orderstatus, feature""")

sql("score_summary", """
SELECT lang, count(*) AS n, round(avg(v), 4) + 0.0 AS mean, round(stddev_pop(v), 4) + 0.0 AS std,
  round(min(v), 4) + 0.0 AS min, round(max(v), 4) + 0.0 AS max,
  """ + ", ".join(f"round(quantile_cont(v, {p / 100}), 4) + 0.0 AS p{p:02d}" for p in (1, 5, 10, 50, 90, 95, 99)) + """
FROM (SELECT lang, CAST(n_chars AS DOUBLE) AS v FROM documents) GROUP BY lang""")


def auc_of(source: str, by: str = "") -> str:
    """Area by mid-ranks of (score, label) rows per group."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {keys}CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg,
  (sum(CASE WHEN label = 1 THEN mid END) - sum(label) * (CAST(sum(label) AS DOUBLE) + 1) / 2)
    / nullif(CAST(sum(label) AS DOUBLE) * sum(1 - label), 0) AS auc
FROM (SELECT *, rank() OVER ({part} ORDER BY score)
        + CAST(count(*) OVER (PARTITION BY {keys}score) - 1 AS DOUBLE) / 2 AS mid
      FROM ({source}) WHERE score IS NOT NULL AND label IS NOT NULL) {group}"""


sql("auc_gini", f"""
SELECT n_pos, n_neg, round(auc, 6) + 0.0 AS auc, round(2 * auc - 1, 6) + 0.0 AS gini
FROM ({auc_of('SELECT CAST(n_chars AS DOUBLE) AS score, quality AS label FROM documents JOIN labels USING (doc_id)')})""")

sql("auc_by_split", f"""
SELECT split, n, positive_rate, round(auc, 6) + 0.0 AS auc, round(2 * auc - 1, 3) + 0.0 AS gini
FROM (SELECT split, count(*) AS n, round(avg(label), 2) + 0.0 AS positive_rate FROM with_split GROUP BY split)
LEFT JOIN ({auc_of('SELECT split, o_totalprice AS score, label FROM with_split', 'split')}) USING (split)""", _SPLIT)

sql("auc_many_ties", f"""
SELECT l_linestatus, n_pos, n_neg, round(auc, 6) + 0.0 AS auc FROM ({auc_of(
    "SELECT l_linestatus, l_quantity AS score, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem",
    "l_linestatus")})""")

sql("balanced_accuracy", """
SELECT o_orderpriority, round(tpr, 6) + 0.0 AS tpr, round(tnr, 6) + 0.0 AS tnr,
  round((tpr + tnr) / 2, 6) + 0.0 AS balanced_accuracy
FROM (SELECT o_orderpriority,
        avg(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice > 250000 AS DOUBLE) END) AS tpr,
        avg(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice <= 250000 AS DOUBLE) END) AS tnr
      FROM orders GROUP BY 1)""")


def binned_psi(samples: str, edges: str) -> str:
    """PSI per feature of (feature, is_base, value) rows over (feature, edges)."""
    return f"""
samples AS ({samples}),
edges AS ({edges}),
bins AS (SELECT feature, edges, unnest(range(1, len(edges))) AS bin FROM edges),
counts AS (
  SELECT feature, is_base, CAST(least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) AS BIGINT) AS bin,
         count(*) AS c
  FROM samples JOIN edges USING (feature)
  WHERE value >= edges[1] AND value <= edges[len(edges)] GROUP BY 1, 2, 3),
shares AS (
  SELECT feature, bin, coalesce(b.c, 0) / sum(CAST(coalesce(b.c, 0) AS DOUBLE)) OVER (PARTITION BY feature) AS e,
         coalesce(t.c, 0) / sum(CAST(coalesce(t.c, 0) AS DOUBLE)) OVER (PARTITION BY feature) AS a
  FROM bins LEFT JOIN (SELECT * FROM counts WHERE is_base) b USING (feature, bin)
            LEFT JOIN (SELECT * FROM counts WHERE NOT is_base) t USING (feature, bin)),
psi AS (
  SELECT feature, sum((greatest(a, 1e-8) - greatest(e, 1e-8)) * ln(greatest(a, 1e-8) / greatest(e, 1e-8))) AS psi
  FROM shares GROUP BY feature)"""


def quantile_edges(source: str, where: str = "is_base", probs: str = DECILES) -> str:
    return (f"SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs}))) AS edges "
            f"FROM {source} WHERE {where} GROUP BY feature")


def even_edges(source: str, bins: int) -> str:
    return (f"SELECT feature, list_concat([lo + (hi - lo) / {bins} * i FOR i IN range({bins})], [hi]) AS edges "
            f"FROM (SELECT feature, min(value) AS lo, max(value) AS hi FROM {source} GROUP BY feature)")


_PRICES = """SELECT feature, year(o_orderdate) < 1999 AS is_base, value FROM (
  SELECT 'o_totalprice' AS feature, o_orderdate, o_totalprice AS value FROM orders
  UNION ALL SELECT 'o_custkey', o_orderdate, CAST(o_custkey AS DOUBLE) FROM orders)"""

sql("psi_two_sample", f"""
SELECT feature, {fixed('edges', 4)} AS edges, round(psi, 8) + 0.0 AS psi
FROM psi JOIN edges USING (feature) WHERE feature = 'o_totalprice'""", binned_psi(_PRICES, quantile_edges("samples")))

sql("psi_equal_width", "SELECT feature, round(psi, 8) + 0.0 AS psi FROM psi",
    binned_psi(_PRICES, even_edges("samples", 10)))

_PERIODS = "SELECT feature, is_base, value FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, year(l_shipdate) < 1998 AS is_base, {c} AS value, l_shipdate FROM lineitem"
    for c in MEASURES) + ")"

sql("csi_features", "SELECT feature, round(psi, 8) + 0.0 AS psi FROM psi",
    binned_psi(_PERIODS, quantile_edges("samples")))
sql("csi_summary", "SELECT round(avg(psi), 8) + 0.0 AS csi_mean, round(max(psi), 8) + 0.0 AS csi_max FROM psi",
    binned_psi(_PERIODS, quantile_edges("samples")))


def _split_psi(other: str) -> str:
    samples = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, split = 'train' AS is_base, CAST({c} AS DOUBLE) AS value "
        f"FROM with_split WHERE split IN ('train', '{other}')" for c in ("o_totalprice", "o_custkey"))
    return f"""SELECT '{other}' AS compared, round(max(CASE WHEN feature = 'o_totalprice' THEN psi END), 8) + 0.0
  AS psi_score, round(avg(CASE WHEN feature = 'o_custkey' THEN psi END), 8) + 0.0 AS csi_mean,
  round(max(CASE WHEN feature = 'o_custkey' THEN psi END), 8) + 0.0 AS csi_max
FROM (WITH {binned_psi(samples, quantile_edges('samples'))} SELECT * FROM psi)"""


sql("psi_train_oot", _split_psi("test") + "\nUNION ALL\n" + _split_psi("oot"), _SPLIT)

# Deciles of the train rows; where some tie, quantiles again for as many bins as their distinct values make.
_TIED = _SPLIT + f""",
scores AS (SELECT split, CAST(floor(o_totalprice / 90000) AS DOUBLE) AS score, CAST(o_custkey AS DOUBLE) AS o_custkey FROM with_split),
first_edges AS (SELECT len(list_distinct(quantile_cont(score, {DECILES}))) - 1 AS b, list_sort(list(score)) AS v
                FROM scores WHERE split = 'train'),
ranks AS (SELECT v, (len(v) - 1) * CASE WHEN i = b THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / b) END AS spot
          FROM (SELECT v, b, unnest(range(0, b + 1)) AS i FROM first_edges)),
tied_edges AS (SELECT list_sort(list_distinct(list(v[floor(spot)::INT + 1]
                 + (v[ceil(spot)::INT + 1] - v[floor(spot)::INT + 1]) * (spot - floor(spot))))) AS edges FROM ranks)"""


def _tied_psi(other: str) -> str:
    samples = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, split = 'train' AS is_base, {c} AS value FROM scores WHERE split IN ('train', '{other}')"
        for c in ("score", "o_custkey"))
    edges = quantile_edges("samples", "is_base AND feature = 'o_custkey'") + " UNION ALL SELECT 'score', edges FROM tied_edges"
    return f"""SELECT '{other}' AS compared, round(max(CASE WHEN feature = 'score' THEN psi END), 8) + 0.0 AS psi_score,
  round(avg(CASE WHEN feature = 'o_custkey' THEN psi END), 8) + 0.0 AS csi_mean,
  round(max(CASE WHEN feature = 'o_custkey' THEN psi END), 8) + 0.0 AS csi_max
FROM (WITH {binned_psi(samples, edges)} SELECT * FROM psi)"""


sql("psi_tied_scores", _tied_psi("test") + "\nUNION ALL\n" + _tied_psi("oot"), _TIED)

_FEATURES = ["score", *s.SCORED_FEATURES]


def baseline(by: str = "") -> str:
    k = f"{by}, " if by else ""
    using = f"{k}feature"
    return f"""
base AS ({long('scored', _FEATURES, [by] if by else [], "snapshot_date < DATE '1998-01-01'")}),
edges AS (SELECT {using}, list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS edges FROM base GROUP BY {using}),
bins AS (SELECT {using}, edges, unnest(range(1, len(edges))) AS bin FROM edges),
base_counts AS (
  SELECT {using}, CAST(least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) AS BIGINT) AS bin, count(*) AS c
  FROM base JOIN edges USING ({using}) WHERE value >= edges[1] AND value <= edges[len(edges)] GROUP BY ALL),
expected AS (
  SELECT {using}, bin, coalesce(c, 0) / sum(CAST(coalesce(c, 0) AS DOUBLE)) OVER (PARTITION BY {using}) AS e
  FROM bins LEFT JOIN base_counts USING ({using}, bin))"""


def against_baseline(by: str, keys: str, source: str = "scored") -> str:
    """PSI per `keys` and feature since 1998 against the baseline kept per `by`."""
    k = f"{by}, " if by else ""
    all_keys = f"{keys}, feature"
    return f"""
target AS ({long(source, _FEATURES, keys.split(', '), "snapshot_date >= DATE '1998-01-01'")}),
target_counts AS (
  SELECT {all_keys}, CAST(least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) AS BIGINT) AS bin, count(*) AS c
  FROM target JOIN edges USING ({k}feature) WHERE value >= edges[1] AND value <= edges[len(edges)] GROUP BY ALL),
groups AS (SELECT DISTINCT {all_keys} FROM target),
actual AS (
  SELECT {all_keys}, bin, e,
    coalesce(coalesce(c, 0) / nullif(sum(CAST(coalesce(c, 0) AS DOUBLE)) OVER (PARTITION BY {all_keys}), 0),
             1.0 / count(*) OVER (PARTITION BY {all_keys})) AS a
  FROM groups JOIN expected USING ({k}feature) LEFT JOIN target_counts USING ({all_keys}, bin)),
psi AS (
  SELECT {keys}, CASE feature WHEN 'score' THEN 'score' ELSE 'feature' END AS metric_kind, feature,
    sum((greatest(a, 1e-8) - greatest(e, 1e-8)) * ln(greatest(a, 1e-8) / greatest(e, 1e-8))) AS psi
  FROM actual GROUP BY {all_keys})"""


sql("baseline_table", f"""
SELECT CASE feature WHEN 'score' THEN 'score' ELSE 'feature' END AS metric_kind, feature,
  {fixed('any_value(edges)', 4)} AS edges, {fixed('list(e ORDER BY bin)')} AS expected
FROM expected JOIN edges USING (feature) GROUP BY feature""", s.SCORED, baseline())

SQL["q_baseline_json"] = SQL["q_baseline_table"]
sql("baseline_stored", f"""
SELECT model_id, CASE feature WHEN 'score' THEN 'score' ELSE 'feature' END AS metric_kind, feature,
  {fixed('any_value(edges)', 4)} AS edges, {fixed('list(e ORDER BY bin)')} AS expected
FROM expected JOIN edges USING (model_id, feature) GROUP BY model_id, feature""", s.SCORED, baseline("model_id"))

_KEYS = "snapshot_date, model_id"
_DRIFT = s.SCORED + "," + baseline() + "," + against_baseline("", _KEYS) + """,
drift AS (
  SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, model_id,
    max(CASE WHEN feature = 'score' THEN psi END) AS psi_score, max(CASE WHEN feature <> 'score' THEN psi END) AS csi_max
  FROM psi GROUP BY ALL),
records AS (
  SELECT snapshot_date, model_id, round(psi_score, 6) + 0.0 AS psi_score, round(csi_max, 6) + 0.0 AS csi_max,
    psi_score >= 0.25 AS psi_breach, csi_max >= 0.25 AS csi_breach, CAST(0.25 AS DOUBLE) AS psi_threshold,
    CAST(0.25 AS DOUBLE) AS csi_threshold FROM drift)"""

sql("psi_vs_baseline", f"SELECT {_KEYS}, metric_kind, feature, round(psi, 6) + 0.0 AS psi FROM psi", _DRIFT)
sql("baseline_per_model", "SELECT model_id, metric_kind, feature, round(psi, 6) + 0.0 AS psi FROM psi",
    s.SCORED, baseline("model_id"), against_baseline("model_id", "model_id"))

_BIN = """CASE WHEN value IS NULL OR isnan(value) THEN -1 WHEN value < edges[1] OR value > edges[len(edges)] THEN 0
  ELSE least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) END"""
sql("bin_state", f"""
SELECT snapshot_date, model_id, feature, CAST({_BIN} AS INTEGER) AS bin, count(*) AS rows
FROM ({long('scored', _FEATURES, ['snapshot_date', 'model_id'])}) JOIN edges USING (feature) GROUP BY ALL""",
    s.SCORED, baseline())

_SPANNED = """
spanned AS (
  SELECT 'quarter' AS span, CAST(date_trunc('quarter', snapshot_date) AS DATE) AS first,
         CAST(date_trunc('quarter', snapshot_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last, * FROM scored
  UNION ALL
  SELECT 'year', CAST(date_trunc('year', snapshot_date) AS DATE),
         CAST(date_trunc('year', snapshot_date) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE), * FROM scored)"""
sql("drift_from_state", """
SELECT *, coalesce(psi_score >= 0.25, false) AS psi_breach, coalesce(csi_max >= 0.25, false) AS csi_breach FROM (
  SELECT span, first, last, model_id, round(max(CASE WHEN feature = 'score' THEN psi END), 6) + 0.0 AS psi_score,
    round(avg(CASE WHEN feature <> 'score' THEN psi END), 6) + 0.0 AS csi_mean,
    round(max(CASE WHEN feature <> 'score' THEN psi END), 6) + 0.0 AS csi_max
  FROM psi GROUP BY span, first, last, model_id)""",
    s.SCORED, _SPANNED, baseline(), against_baseline("", "span, first, last, model_id", "spanned"))

sql("records_from_state", "SELECT * FROM records", _DRIFT)

sql("state_per_model", """
SELECT model_id, metric_kind, feature, n, n_outside, n_missing, round(psi, 6) + 0.0 AS psi
FROM psi JOIN (SELECT model_id, feature, count(*) AS n,
    CAST(count(*) FILTER (value < edges[1] OR value > edges[len(edges)]) AS BIGINT) AS n_outside,
    CAST(count(*) FILTER (value IS NULL) AS BIGINT) AS n_missing
  FROM target JOIN edges USING (model_id, feature) GROUP BY 1, 2) USING (model_id, feature)""",
    s.SCORED, baseline("model_id"), against_baseline("model_id", "model_id"))

sql("baseline_of_state", f"""
SELECT CASE feature WHEN 'score' THEN 'score' ELSE 'feature' END AS metric_kind, feature,
  {fixed('any_value(edges)', 4)} AS edges, {fixed('list(share ORDER BY bin)')} AS expected
FROM (SELECT feature, edges, bin, count(value) / sum(count(value)) OVER (PARTITION BY feature) AS share
      FROM bins LEFT JOIN (SELECT feature, value, {_BIN} AS bin
                           FROM ({long('scored', _FEATURES, [], "year(snapshot_date) = 1998")}) JOIN edges USING (feature)) v
        USING (feature, bin) GROUP BY feature, edges, bin)
GROUP BY feature""", s.SCORED, baseline())

# --- monitoring ----------------------------------------------------------------------------------------

sql("drift_flags", "SELECT * FROM records", _DRIFT)
sql("drift_record_json", "SELECT * FROM records", _DRIFT)

sql("drift_decision", """
SELECT c.snapshot_date, d.model_id, coalesce(psi_score >= 0.02, false) AS psi_breach,
  coalesce(csi_max >= 0.25, false) AS csi_breach,
  CASE WHEN psi_score >= 0.02 OR csi_max >= 0.25 THEN 'retrain' ELSE 'pass' END AS decision
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS snapshot_date) c
LEFT JOIN (SELECT CAST(snapshot_date AS DATE) AS snapshot_date, model_id, psi_score, csi_max FROM drift
           QUALIFY row_number() OVER (PARTITION BY snapshot_date ORDER BY model_id DESC) = 1) d USING (snapshot_date)""",
    _DRIFT)

_NEWEST = s.PREDICTIONS + """,
written AS (SELECT snapshot_date, model_id, max(written_at) AS last_at FROM predictions GROUP BY 1, 2),
picked AS (SELECT snapshot_date, model_id FROM written
           QUALIFY row_number() OVER (PARTITION BY snapshot_date ORDER BY last_at DESC, model_id DESC) = 1),
newest AS (SELECT p.* FROM predictions p JOIN picked USING (snapshot_date, model_id))"""

sql("newest_predictions", "SELECT snapshot_date, model_id, count(*) AS rows FROM newest GROUP BY 1, 2", _NEWEST)

_PERF = _NEWEST + "," + s.ORDER_LABELS + f""",
perf AS (SELECT snapshot_date, model_id, n_pos, n_neg, auc, 2 * auc - 1 AS gini FROM ({auc_of('''
  SELECT n.snapshot_date, n.model_id, n.model_predictions AS score, l.label
  FROM newest n JOIN order_labels l ON n.snapshot_date = l.snapshot_date AND n."Customer_ID" = l."Customer_ID"''',
  'snapshot_date, model_id')}))"""

sql("perf_breach", """
SELECT snapshot_date, model_id, n_pos, n_neg, round(auc, 6) + 0.0 AS auc, round(gini, 6) + 0.0 AS gini,
  coalesce(auc < 0.7, false) AS auc_breach, coalesce(gini < 0.3, false) AS gini_breach,
  coalesce(auc < 0.7 OR gini < 0.3, false) AS breach,
  CASE WHEN auc < 0.7 OR gini < 0.3 THEN 'retrain' ELSE 'done' END AS decision FROM perf""", _PERF)

sql("record_json", """
SELECT snapshot_date, model_id, '{"model_id":"' || model_id || '","n_pos":' || n_pos || ',"n_neg":' || n_neg
  || ',"auc_breach":' || coalesce(auc < 0.7, false) || ',"gini_breach":' || coalesce(gini < 0.3, false)
  || ',"breach":' || coalesce(auc < 0.7 OR gini < 0.3, false)
  || ',"decision":"' || CASE WHEN auc < 0.7 OR gini < 0.3 THEN 'retrain' ELSE 'done' END || '"}' AS record FROM perf""", _PERF)

sql("gauge_rows", """
SELECT metric, snapshot_date, model_id, round(value, 6) + 0.0 AS value FROM (
  SELECT 'ml_auc' AS metric, snapshot_date, model_id, auc AS value FROM perf
  UNION ALL SELECT 'ml_gini', snapshot_date, model_id, gini FROM perf
  UNION ALL SELECT 'ml_auc_threshold', snapshot_date, model_id, 0.7 FROM perf
  UNION ALL SELECT 'ml_gini_threshold', snapshot_date, model_id, 0.3 FROM perf) WHERE value IS NOT NULL""", _PERF)

sql("prediction_store", """
SELECT "Customer_ID", snapshot_date, replace(model_id, 'model_', '00') AS model_id,
  model_predictions, written_at FROM predictions""", s.PREDICTIONS)

sql("hot_key_join", """
SELECT o_orderstatus, o_orderkey FROM orders UNION ALL SELECT 'none', NULL""")

sql("any_known", "SELECT count(label) > 0 AS found FROM order_labels", s.ORDER_LABELS)

sql("metric_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(0.25 AS DOUBLE) AS threshold,
  '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}' AS record FROM events""")

sql("metrics_last_wins", """
SELECT event_type AS metric, CAST(ts AS DATE) AS snapshot_date, user_id % 5 AS model_id, value, ts AS logged_at
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), user_id % 5 ORDER BY ts DESC, event_id DESC) = 1""")

sql("metrics_compacted", """
SELECT event_type AS metric, CAST(ts AS DATE) AS snapshot_date, CAST(user_id % 5 AS VARCHAR) AS model_id, value, ts AS logged_at
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), user_id % 5 ORDER BY ts DESC, event_id DESC) = 1""")

_RUNS = "runs AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date FROM orders)"


def history(table: str, column: str) -> str:
    return f"""
history AS (
  SELECT run_date, (SELECT count(DISTINCT date_trunc('month', {column})) FROM {table}
                    WHERE CAST({column} AS DATE) <= run_date) AS n_months
  FROM runs)"""


sql("train_gate", """
SELECT run_date, CAST(n_months AS INTEGER) AS n_months, month(run_date) IN (3, 6, 9, 12) AND n_months >= 20 AS train
FROM history""", _RUNS, history("lineitem", "l_shipdate"))
sql("infer_gate", """
SELECT run_date, CAST(n_months AS INTEGER) AS n_months, n_months > 20 AS infer FROM history""",
    _RUNS, history("orders", "o_orderdate"))


sql("infer_gate_without_model", """
SELECT run_date, CAST(n_months AS INTEGER) AS n_months, false AS infer FROM history""",
    _RUNS, history("orders", "o_orderdate"))


def resolved(name: str, as_of: str | None = None) -> str:
    before_v = f"AND last_updated <= TIMESTAMP '{as_of}'" if as_of else ""
    before_f = f"WHERE modified <= TIMESTAMP '{as_of}'" if as_of else ""
    return f"""
SELECT coalesce('models:/{name}/' || v, f) AS model,
  coalesce('{name}_' || v, left(f, len(f) - 4)) AS model_id,
  CASE WHEN v IS NOT NULL THEN 'registry' WHEN f IS NOT NULL THEN 'file' END AS source
FROM (SELECT
  (SELECT CAST(p_partkey AS VARCHAR) FROM registry WHERE p_brand = '{name}' {before_v}
   ORDER BY last_updated DESC, p_partkey DESC LIMIT 1) AS v,
  (SELECT file FROM files {before_f} ORDER BY modified DESC, file DESC LIMIT 1) AS f)"""


sql("latest_model", " UNION ALL ".join(
    [resolved("Brand#1"), resolved("Brand#1", "1999-01-20"), resolved("none")]), """
registry AS (SELECT *, TIMESTAMP '1999-01-01' + to_days(p_size) + to_hours(CAST(p_partkey % 24 AS INTEGER))
               AS last_updated FROM part),
files AS (SELECT 'credit_model_' || CAST(s_suppkey AS VARCHAR) || '.pkl' AS file,
                 TIMESTAMP '1999-01-01' + to_days(s_nationkey) AS modified FROM supplier)""")

sql("missing_snapshots", """
SELECT CAST(d AS DATE) AS snapshot_date
FROM (SELECT unnest(generate_series(DATE '1994-06-01', DATE '2002-03-01', INTERVAL 1 MONTH)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)""")

sql("not_yet_trained", """
SELECT run_date FROM runs WHERE run_date NOT IN
  (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem WHERE l_shipdate < DATE '1999-01-01')""", _RUNS)

# --- profile -------------------------------------------------------------------------------------------

_STORE = ["Customer_ID", "Credit_History_Age", "Loans_per_Credit_Item", "Debt_to_Salary", "Loan_Extent",
          "Outstanding_Debt", "Interest_Rate", "Delay_from_due_date", "Changed_Credit_Limit", "Payment_Behaviour",
          "Age", "Occupation", "snapshot_date"]
sql("profile_nulls", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count("{c}") AS n_known, count(*) - count("{c}") AS n_missing
FROM risk_store""" for c in _STORE), s.RISK_STORE)

sql("feature_list", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, {str(numeric).lower()} AS is_numeric, count("{c}") AS n_known,
  {f'round(avg("{c}"), 6) + 0.0' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean,
  {'CAST(NULL AS BIGINT)' if numeric else f'count(DISTINCT "{c}")'} AS n_values FROM silver_attributes"""
    for c, numeric in (("Name", False), ("Age", True), ("SSN", False), ("Occupation", True))), s.SILVER_ATTRIBUTES)

sql("profile_unique", """
SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_distinct, count(*) - count(DISTINCT o_custkey) AS n_repeated
FROM orders""")

sql("profile_top", """
SELECT "Num_of_Delayed_Payment" AS value, count(*) AS rows FROM clean_financials GROUP BY 1
ORDER BY rows DESC, value NULLS LAST LIMIT 25""", s.CLEAN_FINANCIALS)

sql("profile_frequent", """
SELECT o_custkey AS value, count(*) AS rows FROM orders GROUP BY 1 ORDER BY rows DESC, value ASC NULLS LAST LIMIT 25""")

sql("profile_frequent_text", """
SELECT CASE WHEN l_partkey % 5 <> 0 THEN 'part ' || CAST(l_partkey AS VARCHAR) END AS value, count(*) AS rows
FROM lineitem GROUP BY 1 ORDER BY rows DESC, value ASC NULLS LAST LIMIT 25""")

_CUSTOMERS = "m AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)"
sql("cumulative_customers", """
SELECT snapshot_date, count(*) AS n_distinct, CAST(count(*) FILTER (snapshot_date = first) AS BIGINT) AS n_new,
  CAST((SELECT count(DISTINCT o_custkey) FROM m b WHERE b.snapshot_date <= a.snapshot_date) AS BIGINT) AS n_so_far
FROM (SELECT *, min(snapshot_date) OVER (PARTITION BY o_custkey) AS first FROM m) a GROUP BY snapshot_date""", _CUSTOMERS)

sql("customers_of_spans", """
SELECT 'quarter' AS span, CAST(date_trunc('quarter', snapshot_date) AS DATE) AS first,
  CAST(date_trunc('quarter', snapshot_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last,
  count(DISTINCT o_custkey) AS n_distinct FROM m GROUP BY ALL
UNION ALL
SELECT 'year', CAST(date_trunc('year', snapshot_date) AS DATE),
  CAST(date_trunc('year', snapshot_date) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE), count(DISTINCT o_custkey) FROM m GROUP BY ALL""",
    _CUSTOMERS)

sql("profile_hist", """
SELECT feature, CAST(bin AS INTEGER) AS bin, round(edges[bin], 6) + 0.0 AS bin_low, round(edges[bin + 1], 6) + 0.0 AS bin_high,
  coalesce(c, 0) AS rows
FROM bins LEFT JOIN counts USING (feature, bin)""", f"""
samples AS ({long('lineitem', MEASURES)}),
edges AS ({even_edges('samples', 30)}),
bins AS (SELECT feature, edges, unnest(range(1, 31)) AS bin FROM edges),
counts AS (
  SELECT feature, CAST(least(len(list_filter(edges, lambda e: e <= value)), 30) AS BIGINT) AS bin, count(*) AS c
  FROM samples JOIN edges USING (feature) GROUP BY ALL)""")

sql("profile_first", """
SELECT "Customer_ID", record_id, "Credit_Mix" FROM clean_financials ORDER BY "Customer_ID", record_id LIMIT 5""",
    s.CLEAN_FINANCIALS)
sql("profile_missing", """
SELECT * FROM silver_attributes WHERE "Age" IS NULL ORDER BY "Customer_ID" LIMIT 20""", s.SILVER_ATTRIBUTES)
sql("profile_first_date", "SELECT min(snapshot_date) AS first_date, count(*) AS rows FROM label_store", s.LABEL_STORE)


# --- models ---------------------------------------------------------------------------------------------

STUMP_ROWS = """
lines AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS DOUBLE) AS x1,
         coalesce(nullif(l_discount, 0.05), -1e6) AS x0, CAST(l_orderkey % 3 AS INTEGER) AS fold,
         CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS label
  FROM lineitem)"""

# The split of each training sample k with the greatest fall of the variance of labels -1 and 1, and the means beside it.
STUMP_FIT = """
points AS (SELECT k, 0 AS f, x0 AS x, 2 * label - 1 AS y FROM train UNION ALL SELECT k, 1, x1, 2 * label - 1 FROM train),
at_value AS (SELECT k, f, x, count(*) AS n, sum(y) AS y FROM points GROUP BY ALL),
upto AS (
  SELECT k, f, x, CAST(sum(n) OVER upto AS DOUBLE) AS nl, CAST(sum(y) OVER upto AS DOUBLE) AS yl,
         CAST(sum(n) OVER whole AS DOUBLE) AS n, CAST(sum(y) OVER whole AS DOUBLE) AS y
  FROM at_value WINDOW upto AS (PARTITION BY k, f ORDER BY x), whole AS (PARTITION BY k, f)),
splits AS (
  SELECT k, f, x, yl / nl AS mean_left, (y - yl) / (n - nl) AS mean_right, y / n AS mean_all,
         yl * yl / nl / n + (y - yl) * (y - yl) / (n - nl) / n - y * y / n / n AS gain
  FROM upto WHERE nl < n),
stump AS (
  SELECT * FROM splits QUALIFY row_number() OVER (PARTITION BY k ORDER BY gain DESC, f, x) = 1)"""

_MARGIN = "CASE WHEN CASE WHEN f = 0 THEN x0 ELSE x1 END <= x THEN mean_left ELSE mean_right END"

sql("ml_stump", f"""
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-2 * {_MARGIN})), 6) + 0.0 AS model_predictions
FROM lines, stump""", STUMP_ROWS, "train AS (SELECT 0 AS k, * FROM lines WHERE day < DATE '1999-01-01')", STUMP_FIT)

# Fold 3 stands for all rows.
sql("stump_search", f"""
SELECT round(1 / (1 + exp(-2 * margin)), 6) + 0.0 AS model_predictions, count(*) AS rows,
  any_value(best.setting) AS min_info_gain, any_value(round(best.accuracy, 6)) AS balanced_accuracy
FROM margins, best WHERE margins.k = 3 AND margins.setting = best.setting GROUP BY 1""",
    STUMP_ROWS, "train AS (SELECT g.k, lines.* FROM lines, (SELECT unnest([0, 1, 2, 3]) AS k) g WHERE fold <> g.k)",
    STUMP_FIT, f"""
settings AS (SELECT unnest([0.0::DOUBLE, 0.9::DOUBLE]) AS setting),
margins AS (
  SELECT stump.k, setting, lines.fold, label, CASE WHEN gain >= setting THEN {_MARGIN} ELSE mean_all END AS margin
  FROM lines, stump, settings)""", """
per_fold AS (
  SELECT k, setting, (avg(CASE WHEN label = 1 THEN CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END END)
                    + avg(CASE WHEN label = 0 THEN CASE WHEN margin > 0 THEN 0.0 ELSE 1.0 END END)) / 2 AS accuracy
  FROM margins WHERE k = fold GROUP BY ALL),
per_setting AS (SELECT setting, avg(accuracy) AS accuracy FROM per_fold GROUP BY 1),
best AS (SELECT * FROM per_setting ORDER BY accuracy DESC LIMIT 1)""")

sql("tree_scores", """
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-2 * (a + 0.5 * b))), 9) + 0.0 AS model_predictions FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_quantity <= 24 AND d <= 0.03 AND l_tax <= 0.02 THEN -0.75
         WHEN l_quantity <= 24 AND d <= 0.03 THEN -0.25
         WHEN l_quantity <= 24 AND l_extendedprice <= 20000 THEN 0.125
         WHEN l_quantity <= 24 THEN 0.5
         WHEN l_extendedprice <= 45000 AND d <= 0.06 THEN 0.25
         WHEN l_extendedprice <= 45000 THEN 0.375
         ELSE 1.0 END::DOUBLE AS a,
    CASE WHEN d <= 0.05 AND l_quantity <= 10 THEN -1.0
         WHEN d <= 0.05 THEN 0.0625
         WHEN l_tax <= 0.04 AND l_quantity <= 40 THEN 0.5
         WHEN l_tax <= 0.04 THEN -0.5
         ELSE 0.75 END::DOUBLE AS b
  FROM (SELECT *, nullif(l_discount, 0.05) AS d FROM lineitem))""")
