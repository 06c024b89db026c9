"""Arithmetic of the loan, risk and stability columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARE_FLOOR = 1e-8


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; NULL where b is NULL or zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def missed_installments(overdue: Column, due: Column) -> Column:
    return F.coalesce(F.ceil(guarded_ratio(overdue, due)), F.lit(0)).try_cast("int")


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(0)


def capped(c: Column, cap: Column) -> Column:
    """The column limited to `cap` as a double; a NULL cap leaves it alone."""
    value = c.cast("double")
    return F.when(value > cap, cap).otherwise(value)


def loans_per_credit_item(loans: Column, accounts: Column, cards: Column) -> Column:
    return guarded_ratio(loans, accounts + cards + F.lit(1))


def debt_to_salary(debt: Column, salary: Column) -> Column:
    return guarded_ratio(debt, salary + F.lit(1))


def gini(auc: Column) -> Column:
    return auc * 2 - 1


def drop_nan(c: Column) -> Column:
    """The column as a double with NaN turned into NULL."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)

