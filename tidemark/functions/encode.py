"""Closed vocabularies and their integer codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code of each entry is its position.
OCCUPATIONS = [
    "Accountant", "Architect", "Developer", "Doctor", "Engineer", "Entrepreneur", "Journalist", "Lawyer",
    "Manager", "Mechanic", "Media_Manager", "Musician", "Scientist", "Teacher", "Writer",
]
CREDIT_MIXES = ["Bad", "Standard", "Good"]
PAYMENT_BEHAVIOURS = [
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments", "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments", "High_spent_Medium_value_payments", "High_spent_Large_value_payments",
]


def ordinal(c: Column, vocabulary: list[str], default: int | None = None) -> Column:
    """Position of the text in the vocabulary; other texts and NULL give `default`."""
    codes = F.create_map(*[F.lit(x) for pair in zip(vocabulary, range(len(vocabulary))) for x in pair])
    code = F.element_at(codes, c)
    return code if default is None else F.coalesce(code, F.lit(default))


def member_or_null(c: Column, vocabulary: list[str]) -> Column:
    return F.when(c.isin(vocabulary), c)


def occupation(c: Column) -> Column:
    return ordinal(c, OCCUPATIONS, default=len(OCCUPATIONS))


def credit_mix(c: Column) -> Column:
    return ordinal(c, CREDIT_MIXES)


def payment_behaviour(c: Column) -> Column:
    return ordinal(c, PAYMENT_BEHAVIOURS)


def yes_no(c: Column) -> Column:
    return F.when(c == "Yes", True).when(c == "No", False)


def at_least(c: Column, threshold) -> Column:
    """1 where the column reaches the threshold, else 0, also for NULL."""
    return F.when(c >= threshold, 1).otherwise(0)
