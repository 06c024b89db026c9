"""Cleaning of dirty text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNS = ("abs", "keep", "null")


def _strip(c: Column, keep: str, sign: str) -> Column:
    """Drop every character outside `keep`; a leading minus survives unless sign is "abs".

    What is left may be empty, which casts to NULL.
    """
    if sign not in SIGNS:
        raise ValueError(f"sign must be one of {SIGNS}")
    text = c.cast("string")
    body = F.regexp_replace(text, f"[^{keep}]", "")
    if sign == "abs":
        return body
    negative = text.rlike(r"^[^0-9.]*-")
    return F.when(negative & (body != ""), F.concat(F.lit("-"), body)).otherwise(body)


def _drop_negative(number: Column, sign: str) -> Column:
    return F.when(number >= 0, number) if sign == "null" else number


def decimal_text(c: Column, sign: str = "abs") -> Column:
    """Digits and dots of a text as a double; what does not parse is NULL.

    With the default sign the minus is dropped like any other character, so a
    negative amount turns into its absolute value.
    """
    return _drop_negative(_strip(c, "0-9.", sign).try_cast("double"), sign)


def money(c: Column, sign: str = "abs", places: int = 3) -> Column:
    return F.round(decimal_text(c, sign), places)


def integer_text(c: Column, sign: str = "abs") -> Column:
    """Digits of a text as an int; empty and overflowing texts are NULL."""
    return _drop_negative(_strip(c, "0-9", sign).try_cast("int"), sign)


def whole_number(c: Column) -> Column:
    """The column as an int; a decimal text is cut at the dot, other text is NULL."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def age(c: Column, low: int = 0, high: int = 120) -> Column:
    years = integer_text(c)
    return F.when(years.between(low, high), years)


def person_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[^A-Za-z .'-]", ""))


def matching(c: Column, pattern: str) -> Column:
    """The text where it matches, else NULL."""
    return F.when(c.rlike(pattern), c)


def social_security_number(c: Column) -> Column:
    return matching(c, r"^\d{3}-\d{2}-\d{4}$")


def without_sentinel(c: Column, sentinel: str = "_______") -> Column:
    return F.nullif(c, F.lit(sentinel))


def history_months(c: Column) -> Column:
    """"22 Years and 1 Months" as 265; texts not starting so are NULL."""
    pattern = r"^(\d+) Years and (\d+) Months"
    years, months = (F.regexp_extract(c, pattern, i).try_cast("int") for i in (1, 2))
    return F.try_add(F.try_multiply(years, F.lit(12)), months)


def label_definition(dpd: int, mob: int) -> Column:
    return F.concat(F.lit(dpd).cast("string"), F.lit("dpd_"), F.lit(mob).cast("string"), F.lit("mob"))


def model_id_of_uri(uri: Column) -> Column:
    """"models:/name/7" as "name_7"."""
    return F.replace(F.replace(uri, F.lit("models:/"), F.lit("")), F.lit("/"), F.lit("_"))


def model_id_of_file(name: Column) -> Column:
    """File name without its four-character suffix."""
    return F.substring(name, F.lit(1), F.greatest(F.length(name) - 4, F.lit(0)))


def uri_part(uri: Column, position: int) -> Column:
    """Name (1) or version/stage (2) of a "models:/name/version" address."""
    return F.get(F.split(uri, "/"), F.lit(position))


def all_digits(c: Column) -> Column:
    return c.rlike(r"^[0-9]+$")
