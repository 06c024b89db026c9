"""Raw loan, clickstream, attribute and financial tables derived from the test tables.

Each stand-in comes twice: as a DataFrame and as the body of a SQL common table
expression. Both make the same dirty text from the same clean columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Covers every snapshot of the tables.
ALL_DATES = ("1990-01-01", "2010-12-31")


def _text(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _money(c, digits: int = 14):
    return F.col(c).cast(f"decimal({digits},2)").cast("string")


def _month(c):
    return F.trunc(c, "MM")


# --- loans ---------------------------------------------------------------------------------------------

def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    line, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loan_id"),
        _text("o_custkey").alias("Customer_ID"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("loan_start_date"),
        F.lit("10").alias("tenure"),
        F.when(F.col("l_partkey") % 31 == 0, F.concat(_text("l_linenumber"), F.lit(".0")))
        .otherwise(_text("l_linenumber")).alias("installment_num"),
        _money("l_extendedprice").alias("loan_amt"),
        F.when(F.col("l_suppkey") % 50 == 0, "n/a")
        .otherwise(_text(F.round(F.col("l_tax") * 100).cast("int"))).alias("due_amt"),
        _money("l_quantity").alias("paid_amt"),
        _text((F.col("l_quantity") - 25).cast("decimal(14,2)")).alias("overdue_amt"),
        _money("l_extendedprice").alias("balance"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("snapshot_date"),
    )


RAW_LOANS = """
raw_loans AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS loan_id,
         CAST(o_custkey AS VARCHAR) AS "Customer_ID",
         strftime(o_orderdate, '%Y-%m-%d') AS loan_start_date,
         '10' AS tenure,
         CASE WHEN l_partkey % 31 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.0'
              ELSE CAST(l_linenumber AS VARCHAR) END AS installment_num,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS loan_amt,
         CASE WHEN l_suppkey % 50 = 0 THEN 'n/a'
              ELSE CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS due_amt,
         CAST(CAST(l_quantity AS DECIMAL(14,2)) AS VARCHAR) AS paid_amt,
         CAST(CAST(l_quantity - 25 AS DECIMAL(14,2)) AS VARCHAR) AS overdue_amt,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS balance,
         strftime(l_shipdate, '%Y-%m-%d') AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SILVER_LOANS = RAW_LOANS + """,
typed_loans AS (
  SELECT loan_id, "Customer_ID", CAST(loan_start_date AS DATE) AS loan_start_date,
         CAST(tenure AS INTEGER) AS tenure,
         CAST(trunc(TRY_CAST(installment_num AS DOUBLE)) AS INTEGER) AS installment_num,
         TRY_CAST(loan_amt AS FLOAT) AS loan_amt, TRY_CAST(due_amt AS FLOAT) AS due_amt,
         TRY_CAST(paid_amt AS FLOAT) AS paid_amt, TRY_CAST(overdue_amt AS FLOAT) AS overdue_amt,
         TRY_CAST(balance AS FLOAT) AS balance, CAST(snapshot_date AS DATE) AS snapshot_date
  FROM raw_loans),
missed_loans AS (
  SELECT *, installment_num AS mob,
         CAST(coalesce(CASE WHEN due_amt IS NULL OR due_amt = 0 THEN NULL
              ELSE ceil(CAST(overdue_amt AS DOUBLE) / CAST(due_amt AS DOUBLE)) END, 0) AS INTEGER)
           AS installments_missed
  FROM typed_loans),
first_missed AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM missed_loans),
silver_loans AS (
  SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                      ELSE 0 END AS INTEGER) AS dpd
  FROM first_missed)"""

LABEL_STORE = SILVER_LOANS + """,
label_store AS (
  SELECT loan_id, "Customer_ID", CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
         '30dpd_6mob' AS label_def, snapshot_date
  FROM silver_loans WHERE mob = 6)"""


# --- clickstream ---------------------------------------------------------------------------------------

def raw_clicks(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")

    def value(i):
        plain = (key * i) % 997 - 50
        return (
            F.when((key + i) % 89 == 0, "x").when((key + i) % 83 == 0, "")
            .when((key + i) % 79 == 0, F.concat(_text(plain), F.lit(".7")))
            .otherwise(_text(plain)).alias(f"fe_{i}")
        )

    return orders.select(
        *[value(i) for i in range(1, 21)], _text("o_custkey").alias("Customer_ID"),
        F.date_format(_month("o_orderdate"), "yyyy-MM-dd").alias("snapshot_date"),
        key.alias("event_id"),
    )


RAW_CLICKS = """
raw_clicks AS (
  SELECT """ + ",\n         ".join(
    f"""CASE WHEN (o_orderkey + {i}) % 89 = 0 THEN 'x' WHEN (o_orderkey + {i}) % 83 = 0 THEN ''
              WHEN (o_orderkey + {i}) % 79 = 0 THEN CAST((o_orderkey * {i}) % 997 - 50 AS VARCHAR) || '.7'
              ELSE CAST((o_orderkey * {i}) % 997 - 50 AS VARCHAR) END AS fe_{i}""" for i in range(1, 21)) + """,
         CAST(o_custkey AS VARCHAR) AS "Customer_ID",
         strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS snapshot_date,
         o_orderkey AS event_id
  FROM orders)"""

SILVER_CLICKS = RAW_CLICKS + """,
silver_clicks AS (
  SELECT """ + ", ".join(
    f"CAST(trunc(TRY_CAST(fe_{i} AS DOUBLE)) AS INTEGER) AS fe_{i}" for i in range(1, 21)) + """,
         "Customer_ID", CAST(snapshot_date AS DATE) AS snapshot_date, event_id
  FROM raw_clicks)"""


# --- attributes ----------------------------------------------------------------------------------------

def raw_attributes(spark: SparkSession, folder: str) -> DataFrame:
    key, nation = F.col("c_custkey"), _text("c_nationkey")
    valid = F.concat_ws(
        "-", F.lpad(_text(key % 1000), 3, "0"), F.lpad(_text(key % 100), 2, "0"), F.lpad(_text(key % 10000), 4, "0"))
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        _text(key).alias("Customer_ID"),
        F.when(key % 19 != 0, F.concat(F.lit("  "), "c_name", F.lit(" O'Neil-Wu!\t "))).alias("Name"),
        F.when(key % 7 == 0, F.concat(F.lit("-"), nation)).when(key % 7 == 1, "5000").when(key % 7 == 2, "")
        .when(key % 7 == 3, F.concat(nation, F.lit(".5"))).otherwise(F.concat(nation, F.lit("_"))).alias("Age"),
        F.when(key % 2 == 0, valid).when(key % 5 == 0, "#F%$D@*&8").otherwise(F.concat(F.lit("1"), valid)).alias("SSN"),
        F.when(key % 13 != 0, F.when(segment == "BUILDING", "Architect").when(segment == "MACHINERY", "Mechanic")
               .when(segment == "FURNITURE", "_______").when(segment == "HOUSEHOLD", "Writer")
               .otherwise(segment)).alias("Occupation"),
        F.date_format(F.add_months(F.lit("1997-01-01").cast("date"), (key % 24).cast("int")), "yyyy-MM-dd")
        .alias("snapshot_date"),
    )


RAW_ATTRIBUTES = """
raw_attributes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "Customer_ID",
         CASE WHEN c_custkey % 19 <> 0 THEN '  ' || c_name || ' O''Neil-Wu!' || chr(9) || ' ' END AS "Name",
         CASE c_custkey % 7 WHEN 0 THEN '-' || CAST(c_nationkey AS VARCHAR) WHEN 1 THEN '5000' WHEN 2 THEN ''
              WHEN 3 THEN CAST(c_nationkey AS VARCHAR) || '.5'
              ELSE CAST(c_nationkey AS VARCHAR) || '_' END AS "Age",
         CASE WHEN c_custkey % 2 = 0 THEN ssn WHEN c_custkey % 5 = 0 THEN '#F%$D@*&8' ELSE '1' || ssn END AS "SSN",
         CASE WHEN c_custkey % 13 <> 0 THEN
           CASE c_mktsegment WHEN 'BUILDING' THEN 'Architect' WHEN 'MACHINERY' THEN 'Mechanic'
                WHEN 'FURNITURE' THEN '_______' WHEN 'HOUSEHOLD' THEN 'Writer' ELSE c_mktsegment END
         END AS "Occupation",
         strftime(DATE '1997-01-01' + to_months(CAST(c_custkey % 24 AS INTEGER)), '%Y-%m-%d') AS snapshot_date
  FROM (SELECT *, lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' ||
                  lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-' ||
                  lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS ssn FROM customer))"""

SILVER_ATTRIBUTES = RAW_ATTRIBUTES + """,
aged AS (SELECT *, TRY_CAST(regexp_replace("Age", '[^0-9]', '', 'g') AS INTEGER) AS years FROM raw_attributes),
silver_attributes AS (
  SELECT "Customer_ID", trim(regexp_replace("Name", '[^A-Za-z .''-]', '', 'g')) AS "Name",
         CASE WHEN years BETWEEN 0 AND 120 THEN years END AS "Age",
         CASE WHEN regexp_full_match("SSN", '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN "SSN" END AS "SSN",
         CAST(coalesce(list_position(['Accountant', 'Architect', 'Developer', 'Doctor', 'Engineer', 'Entrepreneur',
           'Journalist', 'Lawyer', 'Manager', 'Mechanic', 'Media_Manager', 'Musician', 'Scientist', 'Teacher',
           'Writer'], "Occupation") - 1, 15) AS INTEGER) AS "Occupation",
         snapshot_date
  FROM aged)"""


# --- financials ----------------------------------------------------------------------------------------

def raw_financials(spark: SparkSession, folder: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def odd(every, instead, usual):
        return F.when(key % every == 0, instead).otherwise(usual)

    def joined(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else _text(p) for p in parts])

    price = _money("o_totalprice")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        _text(cust).alias("Customer_ID"),
        joined("_", price, "_").alias("Annual_Income"),
        odd(20, "", joined(key % 9000 + 100, ".", F.lpad(_text(cust % 1000), 3, "0"), "7")).alias("Monthly_Inhand_Salary"),
        F.when(key % 101 == 0, "1.2.3").when(key % 11 == 0, joined("-", price)).otherwise(joined(price, "_"))
        .alias("Outstanding_Debt"),
        joined(cust % 500, ".25").alias("Total_EMI_per_month"),
        odd(23, "__10000__", joined(key % 800, ".5")).alias("Amount_invested_monthly"),
        joined("-", cust % 700, ".125").alias("Monthly_Balance"),
        odd(53, "1756", joined(cust % 11)).alias("Num_Bank_Accounts"),
        odd(67, "999_", joined(key % 9, "_")).alias("Num_Credit_Card"),
        odd(71, "-100", joined(key % 8)).alias("Num_of_Loan"),
        joined(cust % 60 - 5).alias("Delay_from_due_date"),
        odd(43, "", joined(key % 25, "_")).alias("Num_of_Delayed_Payment"),
        odd(37, "99999999999", joined(key % 15)).alias("Num_Credit_Inquiries"),
        odd(59, "5797", joined(cust % 34 + 1)).alias("Interest_Rate"),
        odd(41, "NA", joined(cust % 30, " Years and ", key % 12, " Months")).alias("Credit_History_Age"),
        odd(29, "_", joined(key % 30 - 6, ".5")).alias("Changed_Credit_Limit"),
        joined(key % 25 + 20, ".125").alias("Credit_Utilization_Ratio"),
        F.when(status == "F", "Good").when(status == "O", "Standard").otherwise("_").alias("Credit_Mix"),
        F.when(key % 3 == 0, "Yes").when(key % 3 == 1, "No").otherwise("NM").alias("Payment_of_Min_Amount"),
        F.when(priority == "1-URGENT", "High_spent_Large_value_payments")
        .when(priority == "2-HIGH", "High_spent_Small_value_payments")
        .when(priority == "3-MEDIUM", "Low_spent_Medium_value_payments")
        .when(priority == "5-LOW", "Low_spent_Small_value_payments").otherwise("!@9#%8").alias("Payment_Behaviour"),
        _month("o_orderdate").alias("snapshot_date"),
        key.alias("record_id"),
    )


RAW_FINANCIALS = """
raw_financials AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID",
         '_' || price || '_' AS "Annual_Income",
         CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE CAST(o_orderkey % 9000 + 100 AS VARCHAR) || '.' ||
           lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || '7' END AS "Monthly_Inhand_Salary",
         CASE WHEN o_orderkey % 101 = 0 THEN '1.2.3' WHEN o_orderkey % 11 = 0 THEN '-' || price
              ELSE price || '_' END AS "Outstanding_Debt",
         CAST(o_custkey % 500 AS VARCHAR) || '.25' AS "Total_EMI_per_month",
         CASE WHEN o_orderkey % 23 = 0 THEN '__10000__' ELSE CAST(o_orderkey % 800 AS VARCHAR) || '.5' END
           AS "Amount_invested_monthly",
         '-' || CAST(o_custkey % 700 AS VARCHAR) || '.125' AS "Monthly_Balance",
         CASE WHEN o_orderkey % 53 = 0 THEN '1756' ELSE CAST(o_custkey % 11 AS VARCHAR) END AS "Num_Bank_Accounts",
         CASE WHEN o_orderkey % 67 = 0 THEN '999_' ELSE CAST(o_orderkey % 9 AS VARCHAR) || '_' END AS "Num_Credit_Card",
         CASE WHEN o_orderkey % 71 = 0 THEN '-100' ELSE CAST(o_orderkey % 8 AS VARCHAR) END AS "Num_of_Loan",
         CAST(o_custkey % 60 - 5 AS VARCHAR) AS "Delay_from_due_date",
         CASE WHEN o_orderkey % 43 = 0 THEN '' ELSE CAST(o_orderkey % 25 AS VARCHAR) || '_' END
           AS "Num_of_Delayed_Payment",
         CASE WHEN o_orderkey % 37 = 0 THEN '99999999999' ELSE CAST(o_orderkey % 15 AS VARCHAR) END
           AS "Num_Credit_Inquiries",
         CASE WHEN o_orderkey % 59 = 0 THEN '5797' ELSE CAST(o_custkey % 34 + 1 AS VARCHAR) END AS "Interest_Rate",
         CASE WHEN o_orderkey % 41 = 0 THEN 'NA' ELSE CAST(o_custkey % 30 AS VARCHAR) || ' Years and ' ||
           CAST(o_orderkey % 12 AS VARCHAR) || ' Months' END AS "Credit_History_Age",
         CASE WHEN o_orderkey % 29 = 0 THEN '_' ELSE CAST(o_orderkey % 30 - 6 AS VARCHAR) || '.5' END
           AS "Changed_Credit_Limit",
         CAST(o_orderkey % 25 + 20 AS VARCHAR) || '.125' AS "Credit_Utilization_Ratio",
         CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Standard' ELSE '_' END AS "Credit_Mix",
         CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS "Payment_of_Min_Amount",
         CASE o_orderpriority WHEN '1-URGENT' THEN 'High_spent_Large_value_payments'
              WHEN '2-HIGH' THEN 'High_spent_Small_value_payments'
              WHEN '3-MEDIUM' THEN 'Low_spent_Medium_value_payments'
              WHEN '5-LOW' THEN 'Low_spent_Small_value_payments' ELSE '!@9#%8' END AS "Payment_Behaviour",
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         o_orderkey AS record_id
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price FROM orders))"""

_MONEY = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Total_EMI_per_month",
          "Amount_invested_monthly", "Monthly_Balance"]
_COUNTS = ["Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date",
           "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Interest_Rate"]
_CAPPED = [c for c in _COUNTS if c != "Delay_from_due_date"]

CLEAN_FINANCIALS = RAW_FINANCIALS + """,
clean_financials AS (
  SELECT "Customer_ID", snapshot_date, record_id,
         """ + ",\n         ".join(
    f"""round(TRY_CAST(regexp_replace("{c}", '[^0-9.]', '', 'g') AS DOUBLE), 3) AS "{c}\"""" for c in _MONEY) + ",\n" + ",\n".join(
    f"""         TRY_CAST(regexp_replace("{c}", '[^0-9]', '', 'g') AS INTEGER) AS "{c}\"""" for c in _COUNTS) + """,
         TRY_CAST(regexp_replace("Changed_Credit_Limit", '[^0-9.]', '', 'g') AS DOUBLE) AS "Changed_Credit_Limit",
         TRY_CAST(regexp_replace("Credit_Utilization_Ratio", '[^0-9.]', '', 'g') AS DOUBLE)
           AS "Credit_Utilization_Ratio",
         CAST(TRY_CAST(regexp_extract("Credit_History_Age", '^([0-9]+) Years and ([0-9]+) Months', 1) AS INTEGER) * 12
           + TRY_CAST(regexp_extract("Credit_History_Age", '^([0-9]+) Years and ([0-9]+) Months', 2) AS INTEGER)
           AS INTEGER) AS "Credit_History_Age",
         CAST(CASE "Credit_Mix" WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END AS INTEGER)
           AS "Credit_Mix",
         CASE "Payment_of_Min_Amount" WHEN 'Yes' THEN true WHEN 'No' THEN false END AS "Payment_of_Min_Amount",
         CAST(CASE "Payment_Behaviour" WHEN 'Low_spent_Small_value_payments' THEN 0
              WHEN 'Low_spent_Medium_value_payments' THEN 1 WHEN 'Low_spent_Large_value_payments' THEN 2
              WHEN 'High_spent_Small_value_payments' THEN 3 WHEN 'High_spent_Medium_value_payments' THEN 4
              WHEN 'High_spent_Large_value_payments' THEN 5 END AS INTEGER) AS "Payment_Behaviour"
  FROM raw_financials)"""

SILVER_FINANCIALS = CLEAN_FINANCIALS + """,
caps AS (
  SELECT snapshot_date AS cap_date,
         """ + ",\n         ".join(f'quantile_disc("{c}", 0.97) AS "cap_{c}"' for c in _CAPPED) + """
  FROM clean_financials GROUP BY snapshot_date),
capped AS (
  SELECT c.* REPLACE (
         """ + ",\n         ".join(
    f"""CAST(CASE WHEN "{c}" > "cap_{c}" THEN "cap_{c}" ELSE "{c}" END AS DOUBLE) AS "{c}\"""" for c in _CAPPED) + """)
  FROM clean_financials c JOIN caps ON c.snapshot_date = cap_date),
silver_financials AS (
  SELECT *, "Num_of_Loan" / ("Num_Bank_Accounts" + "Num_Credit_Card" + 1) AS "Loans_per_Credit_Item",
         "Outstanding_Debt" / ("Monthly_Inhand_Salary" + 1) AS "Debt_to_Salary",
         "Delay_from_due_date" * "Num_of_Loan" AS "Loan_Extent"
  FROM capped)"""

RISK_STORE = SILVER_FINANCIALS + "," + SILVER_ATTRIBUTES + """,
risk_store AS (
  SELECT f."Customer_ID", "Credit_History_Age", "Loans_per_Credit_Item", "Debt_to_Salary", "Loan_Extent",
         "Outstanding_Debt", "Interest_Rate", "Delay_from_due_date", "Changed_Credit_Limit", "Payment_Behaviour",
         "Age", "Occupation", f.snapshot_date
  FROM silver_financials f LEFT JOIN silver_attributes a ON f."Customer_ID" = a."Customer_ID")"""


# --- predictions and labels ----------------------------------------------------------------------------

def predictions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        _text(key).alias("Customer_ID"), _month("o_orderdate").alias("snapshot_date"),
        F.concat(F.lit("model_"), _text(key % 3)).alias("model_id"),
        F.when(key % 47 != 0, F.col("o_totalprice") / 600000).alias("model_predictions"),
        F.col("o_orderdate").alias("written_at"))


PREDICTIONS = """
predictions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Customer_ID", CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         'model_' || CAST(o_orderkey % 3 AS VARCHAR) AS model_id,
         CASE WHEN o_orderkey % 47 <> 0 THEN o_totalprice / 600000 END AS model_predictions,
         o_orderdate AS written_at
  FROM orders)"""


def order_labels(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        _text(key).alias("Customer_ID"), _month("o_orderdate").alias("snapshot_date"),
        F.when(key % 17 != 0, (F.col("o_orderstatus") == "F").cast("int")).alias("label"))


ORDER_LABELS = """
order_labels AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Customer_ID", CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS label
  FROM orders)"""


# --- scored feature rows -------------------------------------------------------------------------------

SCORED_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _month("l_shipdate").alias("snapshot_date"),
        F.concat(F.lit("model_"), "l_linestatus").alias("model_id"),
        F.col("l_extendedprice").alias("score"), *SCORED_FEATURES)


SCORED = """
scored AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date, 'model_' || l_linestatus AS model_id,
         l_extendedprice AS score, l_quantity, l_discount, l_tax
  FROM lineitem)"""
