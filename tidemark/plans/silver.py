"""Typed, cleaned and encoded tables; one pass over all snapshots given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import encode, numeric, text
from tidemark.functions.dates import months_before
from tidemark.operators.quantiles import cap_at_quantile
from tidemark.session import write_and_reread
from tidemark.sources.schemas import (
    CAPPED_COLUMNS, CLICK_TYPES, COUNT_COLUMNS, FRACTION_COLUMNS, LOAN_TYPES, MONEY_COLUMNS,
)


def enforce_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns in place; what does not parse is NULL."""
    return df.withColumns({
        c: text.whole_number(F.col(c)) if t == "int" else F.col(c).try_cast(t) for c, t in types.items()
    })


def loans(raw: DataFrame) -> DataFrame:
    """Typed loan rows with mob, installments_missed, first_missed_date and dpd.

    A zero or missing due amount gives no missed installment and hence, for an
    overdue row, no first missed date and an unknown dpd.
    """
    overdue, snapshot = F.col("overdue_amt"), F.col("snapshot_date")
    missed, first = F.col("installments_missed"), F.col("first_missed_date")
    return (
        enforce_schema(raw, LOAN_TYPES)
        .withColumns({
            "mob": F.col("installment_num").cast("int"),
            "installments_missed": numeric.missed_installments(overdue, F.col("due_amt")),
        })
        .withColumn("first_missed_date", F.when(missed > 0, months_before(snapshot, missed)).cast("date"))
        .withColumn("dpd", numeric.days_past_due(overdue, snapshot, first).cast("int"))
    )


def clickstream(raw: DataFrame) -> DataFrame:
    return enforce_schema(raw, CLICK_TYPES)


def attributes(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "Name": text.person_name(F.col("Name")),
        "Age": text.age(F.col("Age")),
        "SSN": text.social_security_number(F.col("SSN")),
        "Occupation": encode.occupation(text.without_sentinel(F.col("Occupation"))),
    })


def financial_values(raw: DataFrame, sign: str = "abs") -> DataFrame:
    """Financial columns cleaned and encoded, before capping.

    `sign` "abs" drops the minus of an amount or count; "null" makes negative
    ones NULL, except for Changed_Credit_Limit, which may fall.
    """
    limit_sign = "keep" if sign == "null" else sign
    cleaned: dict[str, Column] = {
        **{c: text.money(F.col(c), sign) for c in MONEY_COLUMNS},
        **{c: text.integer_text(F.col(c), sign) for c in COUNT_COLUMNS},
        **{c: text.decimal_text(F.col(c), sign) for c in FRACTION_COLUMNS},
        "Changed_Credit_Limit": text.decimal_text(F.col("Changed_Credit_Limit"), limit_sign),
        "Credit_History_Age": text.history_months(F.col("Credit_History_Age")),
        "Credit_Mix": encode.credit_mix(F.col("Credit_Mix")),
        "Payment_of_Min_Amount": encode.yes_no(F.col("Payment_of_Min_Amount")),
        "Payment_Behaviour": encode.payment_behaviour(F.col("Payment_Behaviour")),
    }
    return raw.withColumns(cleaned)


def risk_ratios() -> dict[str, Column]:
    return {
        "Loans_per_Credit_Item": numeric.loans_per_credit_item(
            F.col("Num_of_Loan"), F.col("Num_Bank_Accounts"), F.col("Num_Credit_Card")),
        "Debt_to_Salary": numeric.debt_to_salary(F.col("Outstanding_Debt"), F.col("Monthly_Inhand_Salary")),
    }


def with_ratios(capped: DataFrame) -> DataFrame:
    return capped.withColumns({**risk_ratios(), "Loan_Extent": F.col("Delay_from_due_date") * F.col("Num_of_Loan")})


def financial_columns(raw: DataFrame) -> DataFrame:
    """The columns and types of `financials`, with nothing capped."""
    values = financial_values(raw)
    return with_ratios(values.withColumns({c: F.col(c).cast("double") for c in CAPPED_COLUMNS}))


def financials(raw: DataFrame, sign: str = "abs", cap_prob: float = 0.97, approximate: bool = False) -> DataFrame:
    """Cleaned financial rows, count columns capped per snapshot, and the three ratios.

    The text is cleaned once: the cleaned rows are written, and both the passes
    of the quantiles and the capping read them.
    """
    values = write_and_reread(financial_values(raw, sign), "cleaned")
    return with_ratios(cap_at_quantile(values, CAPPED_COLUMNS, cap_prob, ["snapshot_date"], approximate=approximate))
