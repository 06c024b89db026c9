"""Hand-written rows for the cleaning rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import encode, text
from tidemark.functions.dates import month_calendar, training_windows
from tidemark.plans import gold, silver


def values(spark, build, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("t"))).collect()]


@pytest.mark.parametrize("build, texts, expected", [
    (text.age, ["-23", "28_", "23.5", "500", "", "abc", None, "120", "0"], [23, 28, None, None, None, None, None, 120, 0]),
    (text.person_name, [" Jo3hn O'Neil\t! ", None, "###"], ["John O'Neil", None, ""]),
    (text.social_security_number, ["123-45-6789", "#F%$D@*&8", None, "1123-45-6789"], ["123-45-6789", None, None, None]),
    (lambda c: encode.occupation(text.without_sentinel(c)), ["Accountant", "Writer", "_______", "Pilot", None], [0, 14, 15, 15, 15]),
    (text.money, ["_1234.5678_", "-5.25", "", "1.2.3", None, "."], [1234.568, 5.25, None, None, None, None]),
    (text.integer_text, ["3_", "-1", "", "99999999999", "3.0"], [3, 1, None, None, 30]),
    (text.history_months, ["22 Years and 1 Months", "NA", None, "3 Years and 4 Months ago", "x 3 Years and 4 Months"],
     [265, None, None, 40, None]),
    (encode.credit_mix, ["Bad", "Standard", "Good", "_", None], [0, 1, 2, None, None]),
    (encode.yes_no, ["Yes", "No", "NM", None], [True, False, None, None]),
    (encode.payment_behaviour, ["Low_spent_Small_value_payments", "High_spent_Large_value_payments", "!@9#%8"], [0, 5, None]),
    (text.whole_number, ["3", "3.0", "3.9", "-3.9", "x", "", "99999999999", None], [3, 3, 3, -3, None, None, None, None]),
    (text.model_id_of_uri, ["models:/risk/7"], ["risk_7"]),
    (text.model_id_of_file, ["credit_model_2024_09_01.pkl"], ["credit_model_2024_09_01"]),
])
def test_rule(spark, build, texts, expected):
    assert values(spark, build, texts) == expected


def test_signs(spark):
    assert values(spark, lambda c: text.money(c, "null"), ["-5.25", "5.25", "_-3_"]) == [None, 5.25, None]
    assert values(spark, lambda c: text.money(c, "keep"), ["-5.25", "5.25", "_-3_", "1-2"]) == [-5.25, 5.25, -3.0, 12.0]
    assert values(spark, lambda c: text.integer_text(c, "null"), ["-1", "2"]) == [None, 2]


def loan(spark, **changes):
    row = {"loan_id": "L", "Customer_ID": "C", "loan_start_date": "2024-01-01", "tenure": "10", "installment_num": "6",
           "loan_amt": "1000", "due_amt": "100", "paid_amt": "0", "overdue_amt": "50", "balance": "900",
           "snapshot_date": "2024-03-31", **changes}
    return spark.createDataFrame([row], ", ".join(f"{k} string" for k in row))


@pytest.mark.parametrize("changes, missed, first, dpd, label", [
    ({}, 1, dt.date(2024, 2, 29), 31, 1),
    ({"due_amt": "0"}, 0, None, None, 0),
    ({"due_amt": None}, 0, None, None, 0),
    ({"overdue_amt": "0"}, 0, None, 0, 0),
    ({"overdue_amt": None}, 0, None, 0, 0),
    ({"overdue_amt": "300.3", "due_amt": "100.1"}, 3, dt.date(2023, 12, 31), 91, 1),
    ({"overdue_amt": "broken"}, 0, None, 0, 0),
])
def test_days_past_due(spark, changes, missed, first, dpd, label):
    silver_row = silver.loans(loan(spark, **changes))
    r = silver_row.first()
    assert (r.installments_missed, r.first_missed_date, r.dpd, r.mob) == (missed, first, dpd, 6)
    g = gold.label_store(silver_row).first()
    assert (g.label, g.label_def) == (label, "30dpd_6mob")
    assert gold.label_store(silver_row, mob=5).count() == 0


def test_training_windows(spark):
    r = spark.range(1).select(*[c.alias(n) for n, c in training_windows("2024-09-01").items()]).first()
    assert r.oot_start == dt.date(2024, 7, 1) and r.oot_end == dt.date(2024, 8, 31)
    assert r.train_test_start == dt.date(2023, 7, 1) and r.train_test_end == dt.date(2024, 6, 30)


def test_calendar(spark):
    months = [r[0] for r in month_calendar(spark, "2023-01-15", "2024-12-01").collect()]
    assert len(months) == 24 and months[0] == dt.date(2023, 1, 1) and months[-1] == dt.date(2024, 12, 1)


def clicks(spark, rows):
    return spark.createDataFrame(
        [(c, dt.date.fromisoformat(m), v) for c, m, v in rows], "Customer_ID string, snapshot_date date, fe_1 int")


def test_engagement_gaps_and_scaffold(spark):
    df = clicks(spark, [("a", "2023-01-01", 1), ("b", "2023-01-01", 2), ("a", "2023-03-01", 3), ("a", "2023-03-01", 9)])
    rows = {(r.Customer_ID, str(r.snapshot_date)): tuple(r)[2:]
            for r in gold.engagement_store(df, "2023-01-01", "2023-10-01").collect()}
    none = (None,) * 6
    assert rows["a", "2023-01-01"] == none and rows["b", "2023-01-01"] == none
    assert rows["a", "2023-04-01"] == (3, None, 1, None, None, None)
    assert rows["b", "2023-07-01"] == (None,) * 5 + (2,)
    assert ("b", "2023-08-01") not in rows and ("a", "2023-10-01") not in rows
    assert rows["a", "2023-09-01"] == (None,) * 5 + (3,)
    # March has history, so it is no scaffold: only customers seen before March are listed.
    assert rows["a", "2023-03-01"] == (None, 1, None, None, None, None)


def test_engagement_of_one_snapshot_without_any_data(spark):
    df = clicks(spark, [("a", "2023-01-01", 1)])
    assert gold.engagement_store(df, "2022-05-01", "2022-05-01").count() == 0
