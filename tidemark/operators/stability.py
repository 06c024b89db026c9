"""Histograms, stability indices and the monitoring baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bins import edge_columns, even_bin, even_edges, histogram_bin
from tidemark.functions.numeric import SHARE_FLOOR
from tidemark.operators.bounded import feature_spine, known_values, lookup, stored, to_long
from tidemark.operators.quantiles import even_probabilities, exact_quantiles


def bin_counts(binned: DataFrame, keys) -> DataFrame:
    """(keys, filled) with a map bin -> rows; rows without a bin only keep their group alive."""
    counts = binned.groupBy(*keys, "bin").agg(F.count("*").alias("rows"))
    return counts.groupBy(*keys).agg(F.expr(
        "map_from_entries(collect_list(if(bin is null, null, struct(bin, rows))))").alias("filled"))


def counts_array(filled: str, bins: str) -> Column:
    """Rows of bins 1..bins, zero where the map has none."""
    return F.expr(f"transform(sequence(1, {bins}), i -> coalesce(try_element_at({filled}, i), 0L))")


def shares(filled: str, bins: str) -> Column:
    """Shares of bins 1..bins in their total, one share for each bin where the total is zero."""
    total = f"aggregate(map_values({filled}), 0L, (a, c) -> a + c)"
    return F.expr(
        f"transform(sequence(1, {bins}), i -> if({total} = 0, 1.0D / ({bins}), "
        f"coalesce(try_element_at({filled}, i), 0L) / {total}))")


def stability_index(expected: str, actual: str) -> Column:
    """Sum over bins of (a - e) ln(a / e), shares held to [1e-8, 1]; NULL for a NULL side."""
    def held(x):
        return f"transform({x}, s -> greatest(least(s, 1.0D), {SHARE_FLOOR!r}D))"

    return F.expr(
        f"aggregate(zip_with({held(expected)}, {held(actual)}, (e, a) -> (a - e) * ln(a / e)), 0.0D, (s, t) -> s + t)")


def quantile_edges(df: DataFrame, columns, bins: int = 10, by=()) -> DataFrame:
    """(by..., feature, n, edges) with the distinct quantiles as sorted edges."""
    q = exact_quantiles(df, columns, even_probabilities(bins), by)
    return q.select(*by, "feature", "n", F.array_sort(F.array_distinct("quantiles")).alias("edges"))


def _edge_side(edges: DataFrame, on, max_edges: int) -> DataFrame:
    """Edges as columns with the number of bins and the last edge."""
    side = edges.select(*on, "edges", F.expr("size(edges) - 1 as bins"), F.expr("element_at(edges, -1) as last_edge"))
    return edge_columns(side, "edges", max_edges)


def edge_histogram(df: DataFrame, columns, edges: DataFrame, by=(), edges_by=(), max_edges: int = 11) -> DataFrame:
    """(by..., feature, filled) for given edges; columns without edges are left out.

    `edges` has (edges_by..., feature, edges); `edges_by` is part of `by`. A
    group whose values are all missing keeps a row with an empty map.
    """
    keys, on = [*by, "feature"], [*edges_by, "feature"]
    binned = lookup(to_long(df, by, columns), _edge_side(edges, on, max_edges), on).select(
        *keys, histogram_bin("value", "bins", max_edges).alias("bin"))
    return bin_counts(binned, keys)


def even_ranges(df: DataFrame, columns, bins: int, by=()) -> DataFrame:
    """(by..., feature, low, high, edges) of `bins` bins of one width."""
    span = known_values(to_long(df, by, columns)).groupBy(*by, "feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high"))
    return span.withColumn("edges", even_edges("low", "high", bins))


def even_histogram(df: DataFrame, columns, bins: int = 30) -> DataFrame:
    """(feature, bin, bin_low, bin_high, rows) with every bin, empty ones too."""
    span = stored(even_ranges(df, columns, bins))
    binned = lookup(known_values(to_long(df, (), columns)), span.select("feature", "low", "high"), ["feature"])
    counts = bin_counts(binned.select("feature", even_bin("value", "low", "high", bins).alias("bin")), ["feature"])
    wide = lookup(counts, span, ["feature"]).withColumn("counts", counts_array("filled", str(bins)))
    return wide.select("feature", "edges", F.expr("posexplode(counts) as (at, rows)")).selectExpr(
        "feature", "at + 1 as bin", "edges[at] as bin_low", "edges[at + 1] as bin_high", "rows")


def _psi_rows(spine: DataFrame, edges: DataFrame, sides: DataFrame, on, flat: str) -> DataFrame:
    """Add edges and psi to the spine; every table has one row per sample and listed column."""
    wide = spine.join(edges.select("feature", "edges"), "feature", "left").join(sides, on, "left").withColumns({
        "expected": shares("base", "size(edges) - 1"), "actual": shares("target", "size(edges) - 1")})
    known = F.expr("base is not null and target is not null")
    psi = F.when(known & F.expr(flat), 0.0).when(known, stability_index("expected", "actual"))
    return wide.select(*spine.columns, "edges", psi.alias("psi"))


def psi_by_sample(df: DataFrame, columns, sample: str, base: str, others, bins: int = 10,
                  edges: DataFrame | None = None) -> DataFrame:
    """(sample, feature, edges, psi) of each other sample of a table against its base sample.

    Edges are the distinct quantiles of the base unless given. NULL where a
    sample has no values; 0 where the base has a single value.
    """
    columns, spark = list(columns), df.sparkSession
    rows = df.select(F.col(sample).alias("sample"), *columns).filter(F.col("sample").isin(base, *others))
    if edges is None:
        edges = stored(quantile_edges(rows.filter(F.col("sample") == base), columns, bins).drop("n"))
    long = known_values(to_long(rows, ["sample"], columns))
    binned = lookup(long, _edge_side(edges, ["feature"], bins + 1), ["feature"]).select(
        "sample", "feature", histogram_bin("value", "bins", bins + 1).alias("bin"))
    counts = stored(bin_counts(binned, ["sample", "feature"]))
    is_base = F.col("sample") == base
    sides = counts.filter(~is_base).withColumnRenamed("filled", "target").join(
        counts.filter(is_base).select("feature", F.col("filled").alias("base")), "feature")
    spine = spark.createDataFrame([(o, c) for o in others for c in columns], "sample string, feature string")
    return _psi_rows(spine, edges, sides, ["sample", "feature"], "size(edges) < 2")


def psi_two_sample(df: DataFrame, columns, is_base: Column, bins: int = 10, use_quantiles: bool = True) -> DataFrame:
    """(feature, edges, psi) of target rows against base rows of one table.

    `is_base` is true for base rows, false for target rows, NULL for neither.
    Edges are the distinct quantiles of the base, or bins of one width over both
    samples. NULL where a sample has no values; 0 where there is a single value.
    """
    columns = list(columns)
    if use_quantiles:
        side = F.when(is_base, "base").when(~is_base, "target")
        rows = df.select(*columns, side.alias("__side"))
        return psi_by_sample(rows, columns, "__side", "base", ["target"], bins).drop("sample")
    rows = df.select(*columns, is_base.alias("is_base")).filter("is_base is not null")
    edges = stored(even_ranges(rows, columns, bins))
    binned = lookup(known_values(to_long(rows, ["is_base"], columns)), edges.drop("edges"), ["feature"]).select(
        "is_base", "feature", even_bin("value", "low", "high", bins).alias("bin"))
    sides = bin_counts(binned, ["is_base", "feature"]).groupBy("feature").agg(
        F.expr("any_value(if(is_base, filled, null), true)").alias("base"),
        F.expr("any_value(if(is_base, null, filled), true)").alias("target"),
    )
    spine = feature_spine(df.sparkSession, columns)
    return _psi_rows(spine, edges, sides, ["feature"], f"edges[0] = edges[{bins}]")


def csi_summary(psi: DataFrame, by=()) -> DataFrame:
    """Mean and maximum of the per-feature indices; features without one do not count."""
    known = psi.filter("psi is not null and not isnan(psi)")
    return known.groupBy(*by).agg(F.avg("psi").alias("csi_mean"), F.max("psi").alias("csi_max"))


def monitoring_baseline(df: DataFrame, features, score: str | None = "score", bins: int = 10, by=()) -> DataFrame:
    """(by..., metric_kind, feature, edges, expected): decile edges and training shares.

    A column of one value gets the edge pair [v, v], a column without values
    [0, 1]; the score column is told apart by its metric_kind.
    """
    columns, by = [*features, *([score] if score else [])], list(by)
    keys = [*by, "feature"]
    found = quantile_edges(df, columns, bins, by).drop("n")
    spine = feature_spine(df.sparkSession, columns)
    if by:
        groups = df.select(*by).distinct()
        spine = groups.select("*", F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    edges = lookup(spine, found, keys, "left").withColumn("edges", F.expr("""
        case when edges is null then array(0.0D, 1.0D) when size(edges) < 2 then array(edges[0], edges[0])
             else edges end"""))
    edges = stored(edges)
    counts = edge_histogram(df, columns, edges, by=by, edges_by=by, max_edges=bins + 1)
    kind = F.when(F.col("feature") == F.lit(score or ""), "score").otherwise("feature")
    return lookup(edges, counts, keys, "left").withColumn("filled", F.coalesce("filled", F.expr("map()"))).select(
        *by, kind.alias("metric_kind"), "feature", "edges", shares("filled", "size(edges) - 1").alias("expected"))


def psi_against_baseline(df: DataFrame, columns, baseline: DataFrame, by=(), baseline_by=(),
                         max_edges: int = 11) -> DataFrame:
    """(by..., metric_kind, feature, psi) of each group against stored edges and shares.

    Only columns found in the baseline take part. A group without any value
    counts as evenly spread, as does one whose values all lie off the edges.
    """
    known = stored(baseline.select(*baseline_by, "metric_kind", "feature", "edges", "expected"))
    counts = edge_histogram(df, columns, known, by, baseline_by, max_edges)
    joined = lookup(counts, known, [*baseline_by, "feature"]).withColumn(
        "actual", shares("filled", "size(edges) - 1"))
    return joined.select(*by, "metric_kind", "feature", stability_index("expected", "actual").alias("psi"))
