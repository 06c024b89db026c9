"""Counts per bin as stored state: made once per snapshot, summed over any span, and judged without the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bins import edge_columns, histogram_bin
from tidemark.operators.bounded import lookup, stored, to_long
from tidemark.operators.stability import shares, stability_index

OUTSIDE, MISSING = 0, -1
STATE_SCHEMA = "feature string, edges_id long, bin int, rows long"


def edges_id(edges: str = "edges"):
    """A number that tells one list of edges from another, so that only counts over the same edges are summed."""
    return F.xxhash64(F.col(edges))


def bin_state(df: DataFrame, columns, baseline: DataFrame, by=(), baseline_by=(), max_edges: int = 11) -> DataFrame:
    """(by..., feature, edges_id, bin, rows): the rows of each group in each bin of the baseline's edges.

    Bins count from 1; values outside the edges are in bin 0, missing ones and
    NaN in bin -1, so a group is never lost and its rows can be told from any
    column. Only columns of the baseline take part; `baseline_by` is part of
    `by`. The counts are sums: the state of a union of rows is the sum of the
    states. The table has at most bins + 2 rows per group and column.
    """
    keys, on = [*by, "feature"], [*baseline_by, "feature"]
    known = stored(baseline.select(*on, "edges"))
    side = edge_columns(
        known.select(*on, "edges", edges_id().alias("edges_id"), F.expr("size(edges) - 1 as bins"),
                     F.expr("element_at(edges, -1) as last_edge")), "edges", max_edges)
    place = F.when(F.expr("value is null or isnan(value)"), MISSING).otherwise(
        F.coalesce(histogram_bin("value", "bins", max_edges), F.lit(OUTSIDE)))
    binned = lookup(to_long(df, by, columns), side, on).select(*keys, "edges_id", place.cast("int").alias("bin"))
    return binned.groupBy(*keys, "edges_id", "bin").agg(F.count("*").alias("rows"))


def merged(state: DataFrame, by=()) -> DataFrame:
    """The state summed over everything but `by`."""
    return state.groupBy(*by, "feature", "edges_id", "bin").agg(F.sum("rows").alias("rows"))


def over_spans(state: DataFrame, spans: DataFrame, by=(), date: str = "snapshot_date") -> DataFrame:
    """The state of each span of snapshots: (spans' columns..., by..., feature, edges_id, bin, rows).

    `spans` has first and last, closed, and any columns that name them; spans may
    overlap. State rows are few per snapshot, so a row goes to every span that
    holds its snapshot.
    """
    names = spans.columns
    inside = state.join(spans, state[date].between(spans["first"], spans["last"])).select(
        *[spans[c] for c in names], *[state[c] for c in by], "feature", "edges_id", "bin", "rows")
    return merged(inside, [*names, *by])


def psi_of_state(state: DataFrame, baseline: DataFrame, by=(), baseline_by=()) -> DataFrame:
    """(by..., metric_kind, feature, n, n_outside, n_missing, psi) from counts alone.

    As `psi_against_baseline` gives from the rows: a group without any value
    inside the edges counts as evenly spread. Counts over edges other than the
    baseline's are left out; `stale` tells whose they are.
    """
    on = [*baseline_by, "feature"]
    known = stored(baseline.select(*on, "metric_kind", "edges", "expected", edges_id().alias("edges_id")))
    counts = state.groupBy(*by, "feature", "edges_id").agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("bin") == OUTSIDE, F.col("rows")).otherwise(0)).alias("n_outside"),
        F.sum(F.when(F.col("bin") == MISSING, F.col("rows")).otherwise(0)).alias("n_missing"),
        F.expr("map_from_entries(collect_list(if(bin > 0, struct(bin, rows), null)))").alias("filled"))
    joined = lookup(counts, known, [*on, "edges_id"]).withColumn("actual", shares("filled", "size(edges) - 1"))
    return joined.select(
        *by, "metric_kind", "feature", "n", "n_outside", "n_missing", stability_index("expected", "actual").alias("psi"))


def stale(state: DataFrame, baseline: DataFrame, by=(), baseline_by=()) -> DataFrame:
    """(by..., feature): groups whose counts were made over other edges than the baseline's, and must be made again."""
    on = [*baseline_by, "feature"]
    now = stored(baseline.select(*on, edges_id().alias("__now")))
    return lookup(state.select(*by, "feature", "edges_id").distinct(), now, on).filter("edges_id <> __now").select(
        *by, "feature").distinct()


def baseline_of_state(state: DataFrame, edges: DataFrame, by=(), edges_by=()) -> DataFrame:
    """(by..., metric_kind, feature, edges, expected): a new baseline with the edges of an old one and the state's shares.

    A span of snapshots thus becomes the reference without a scan of its rows.
    """
    on = [*edges_by, "feature"]
    known = stored(edges.select(*on, "metric_kind", "edges", edges_id().alias("edges_id")))
    counts = merged(state, by).groupBy(*by, "feature", "edges_id").agg(
        F.expr("map_from_entries(collect_list(if(bin > 0, struct(bin, rows), null)))").alias("filled"))
    return lookup(counts, known, [*on, "edges_id"]).select(
        *by, "metric_kind", "feature", "edges", shares("filled", "size(edges) - 1").alias("expected"))
