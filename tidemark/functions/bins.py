"""Position of a value among sorted edges; arguments are column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edge_columns(df: DataFrame, edges: str, max_edges: int) -> DataFrame:
    """Spread a sorted array over the columns e0, e1, ..., NaN where it is shorter.

    Plain columns compare within generated code without touching an array, and
    NaN sorts above every number.
    """
    spread = [f"coalesce(get({edges}, {i}), double('NaN')) as e{i}" for i in range(max_edges)]
    return df.selectExpr(*[c for c in df.columns if c != edges], *spread)


def reached_sql(value: str, max_edges: int) -> str:
    """How many of the edge columns are <= value."""
    return "(" + " + ".join(f"int(e{i} <= {value})" for i in range(max_edges)) + ")"


def edges_reached(value: str, max_edges: int) -> Column:
    return F.expr(reached_sql(value, max_edges))


def histogram_bin(value: str, bins: str, max_edges: int) -> Column:
    """1-based of `bins` bins, half open but for the last, which is closed; NULL outside the edges.

    Reads the edge columns and `last_edge`.
    """
    inside = f"{value} >= e0 and {value} <= last_edge and not isnan({value})"
    return F.expr(f"if({inside}, least({reached_sql(value, max_edges)}, {bins}), null)")


def even_edges(low: str, high: str, bins: int) -> Column:
    """Edges of `bins` bins of one width between low and high."""
    return F.expr(
        f"concat(transform(sequence(0, {bins - 1}), i -> {low} + ({high} - {low}) / {bins} * i), array({high}))")


def even_bin(value: str, low: str, high: str, bins: int) -> Column:
    """`histogram_bin` for `even_edges` without visiting the edges.

    The quotient may land one bin off by rounding, so it is set right against
    the two edges next to it.
    """
    step = f"(({high} - {low}) / {bins})"
    guess = f"least(floor(({value} - {low}) / {step}), {bins - 1})"
    edge = f"{low} + {step} * "
    return F.expr(f"""
        case when not {low} < {high} or isnan({value}) or not {value} between {low} and {high} then null
             when {value} < {edge} {guess} then int({guess})
             when {guess} < {bins - 1} and {value} >= {edge} ({guess} + 1) then int({guess}) + 2
             else int({guess}) + 1 end""")
