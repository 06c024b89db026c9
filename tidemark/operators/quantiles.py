"""Exact quantiles of large columns without bringing a column to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bins import edge_columns, edges_reached
from tidemark.functions.numeric import capped
from tidemark.operators.bounded import known_values, lookup, running_total, stored, to_long
from tidemark.operators.sketches import quantile_sketches, sketch_quantiles

SKETCH_ACCURACY = 2_000
LARGEST_SKETCH = 65_535


def even_probabilities(bins: int) -> list[float]:
    """0, 1/bins, ..., 1 in the floating-point steps of an evenly spaced grid."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def _doubles(values) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def _positions(probs, method: str) -> str:
    """Array of (lower rank, upper rank, weight of the upper) per probability, ranks from 1."""
    if method == "disc":
        rank = "greatest(bigint(ceil(p * n)), 1L)"
        one = f"named_struct('low', {rank}, 'high', {rank}, 'weight', 0.0D)"
    else:
        low = "bigint(floor((n - 1) * p))"
        one = f"named_struct('low', {low} + 1, 'high', least({low} + 2, n), 'weight', (n - 1) * p - {low})"
    return f"transform({_doubles(probs)}, p -> {one})"


# Between two neighbours, from the nearer one.
_INTERPOLATED = """transform(places, x -> if(x.weight >= 0.5D,
    at[x.high] - (at[x.high] - at[x.low]) * (1 - x.weight),
    at[x.low] + (at[x.high] - at[x.low]) * x.weight))"""


def exact_quantiles(df: DataFrame, columns, probs, by=(), method: str = "linear",
                    accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Quantiles of each column per group: (by..., feature, n, quantiles).

    "linear" interpolates between neighbours; "disc" takes the first value whose
    cumulative share reaches the probability. NULL and NaN do not count; a
    column without values has no row.

    One pass sketches a narrow fence around each probability, a second counts
    the rows between the fences, a third ranks only the values inside the few
    intervals that hold a wanted rank, over as many tasks as their size asks
    for. Ranks come from the counts, so the result is exact whatever the sketch
    says; the sketch only keeps the last pass small. All passes read `df`.
    `by` is meant for calendar or model keys: the per-group tables have one row
    per group and column.
    """
    by, probs = list(by), [float(p) for p in probs]
    keys = [*by, "feature"]
    margin = 4.0 / accuracy
    fence_at = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    long = known_values(to_long(df, by, columns))

    sketched = quantile_sketches(df, columns, by, min(2 * accuracy, LARGEST_SKETCH))
    fences = stored(sketch_quantiles(sketched, fence_at).withColumnRenamed("quantiles", "fences"))

    def slotted(side):
        wide = edge_columns(side, "fences", len(fence_at))
        return lookup(long, wide, keys).withColumn("slot", edges_reached("value", len(fence_at)))

    counts = (
        slotted(fences.select(*keys, "fences")).groupBy(*keys, "slot").agg(F.count("*").alias("rows"))
        .groupBy(*keys).agg(F.expr("map_from_entries(collect_list(struct(slot, rows)))").alias("filled"))
    )
    # Rank r lies in the interval that starts at the last fence with fewer than r rows below it.
    groups = stored(
        lookup(counts, fences, keys)
        .withColumn("below", F.expr("""transform(fences, (f, i) ->
            aggregate(sequence(0, i), 0L, (sum, s) -> sum + coalesce(try_element_at(filled, s), 0L)))"""))
        .withColumn("places", F.expr(_positions(probs, method)))
        .withColumn("ranks", F.expr("array_distinct(concat(places.low, places.high))"))
        .withColumn("slots", F.expr("array_distinct(transform(ranks, r -> size(filter(below, b -> b < r))))"))
        .drop("filled")
    )

    inside = slotted(groups.select(*keys, "fences", "slots")).filter("array_contains(slots, slot)")
    distinct = inside.groupBy(*keys, "slot", "value").agg(F.count("*").alias("rows"))
    ranked = running_total(distinct, [*keys, "slot"], "value", "rows", "upto")
    found = lookup(ranked, groups.select(*keys, "n", "below", "ranks", "places"), keys).withColumn(
        "upto", F.expr("upto + if(slot = 0, 0L, below[slot - 1])"))
    return (
        found.select(*keys, "n", "places", "value", F.expr(
            "explode(filter(ranks, r -> r > upto - rows and r <= upto)) as rank"))
        .groupBy(*keys, "n", "places")
        .agg(F.expr("map_from_entries(collect_list(struct(rank, value)))").alias("at"))
        .select(*keys, "n", F.expr(_INTERPOLATED).alias("quantiles"))
    )


def cap_at_quantile(df: DataFrame, columns, prob: float = 0.97, by=("snapshot_date",),
                    accuracy: int = SKETCH_ACCURACY, approximate: bool = False, sketches: DataFrame | None = None) -> DataFrame:
    """Limit each column to its quantile within the snapshot; capped columns become doubles.

    Exact quantiles read `df` several times: hand in a stored table. With `approximate` the caps come from
    mergeable sketches, made in one pass or handed in as `sketches` (by..., feature, n, sketch), as they were
    stored; a cap's rank is then off by half a hundredth of the rows at most (see `sketches.SKETCH_SIZE`).
    """
    by = list(by)
    if approximate or sketches is not None:
        held = quantile_sketches(df, columns, by) if sketches is None else sketches
        found = sketch_quantiles(held.filter(F.col("feature").isin(list(columns))), [prob])
    else:
        found = exact_quantiles(df, columns, [prob], by, "disc", accuracy)
    cap = F.expr("map_from_entries(collect_list(struct(feature, quantiles[0])))").alias("__caps")
    caps = stored(found.groupBy(*by).agg(cap))
    return lookup(df, caps, by, "left").withColumns(
        {c: capped(F.col(c), F.element_at("__caps", F.lit(c))) for c in columns}
    ).drop("__caps")
