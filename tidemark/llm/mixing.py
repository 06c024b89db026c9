"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import word_count
from tidemark.session import write_and_reread

# Weight classes of the sources, in turn, and the shape of each schedule: relative weight at the start of training
# (at its end it is two minus that, and in between a straight line).
WEIGHTS = (1.0, 2.0, 3.0)
SHAPES = (1.5, 1.0, 0.5)


def targets(sizes: DataFrame, weights=WEIGHTS, shapes=SHAPES, most: float = 3.0) -> DataFrame:
    """(source, source_size, target, shape) from (source, source_size).

    Sources in code-point order, NULL last, take the weights in turn; a weight
    is the integral of the source's schedule over training. They share the sum
    of all sizes by weight. No target is above `most` times its source's size:
    the excess is shared by weight among the others until none is above. With
    the sources sorted by the level at which they hit their limit, that end
    point is found in one pass: the level of those not yet at their limit is
    the rest of the sum over their weights. The windows without keys sort one
    row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    at = (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), at)
    full = Window.orderBy("hits", "rank")
    everything = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, onward = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    levels = (
        sizes.select("source", "source_size", rank.alias("rank"), pick(weights).alias("weight"), pick(shapes).alias("shape"))
        .withColumn("hits", most * F.col("source_size") / F.col("weight"))
        .withColumns({
            "used": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most,
            "rest": F.sum("weight").over(onward),
            "all": F.sum("source_size").over(everything)})
        # The first source whose limit is not reached by the level of the rest sets the level for all after it.
        .withColumn("level", (F.col("all") - F.col("used")) / F.col("rest"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("hits"), F.struct("hits", "rank", "level"))).over(everything)["level"])
    )
    target = F.least(most * F.col("source_size").cast("double"), F.col("weight") * F.col("level"))
    return levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"), "shape")


def position(demand: Column, shape: Column) -> Column:
    """Training time, 0 to 1, at which a source's cumulative demand reaches this share of its target.

    The schedule's relative weight is the line from shape to 2 - shape, so its
    integral is shape * t + (1 - shape) * t^2, which is solved for t.
    """
    return 2 * demand / (shape + F.sqrt(F.greatest(shape * shape + 4 * (1 - shape) * demand, F.lit(0.0))))


def plan(sized: DataFrame, key: str = "doc_id", rows_per_bucket: int = 10_000, seed: int = 42, **mix) -> DataFrame:
    """Add source_size, target, copies, __start and shape to rows with `source` and `size`.

    `sized` should be a written table. Documents of a source lie in the order of
    a seeded hash of key and size, over and over, on a line of words; a copy
    belongs to the mix if its middle lies below the target, which is so for the
    first few rounds and a part of the last. So no source is off its target by
    more than half a document, and no document is more than one copy ahead of
    another. Places on the line come from running sums inside hash ranges plus
    the sums of the ranges before. The number of ranges follows the row count,
    so a window task keeps its size however many rows a source has; a window
    over ranges has one row per range. Rows without words are never taken.
    Repeated rows are rows of their own; which of them comes first is open, but
    they are the same.
    """
    ranges = max(1, -(-sized.count() // rows_per_bucket))
    order = F.xxhash64(F.lit(seed), F.col(key), F.col("size"))
    placed = sized.withColumn("__hash", order).withColumn(
        "__range", F.floor((F.col("__hash").cast("double") / 2.0**64 + 0.5) * ranges).cast("int"))
    per_range = placed.groupBy("source", "__range").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source")
    ranged = write_and_reread(per_range.select(
        "source", "__range", (F.sum("words").over(over.orderBy("__range")) - F.col("words")).alias("__before"),
        F.sum("words").over(over).alias("source_size")), "ranges")
    goals = targets(ranged.groupBy("source").agg(F.first("source_size").alias("source_size")), **mix)
    goals = write_and_reread(goals, "targets")
    lines = ranged.drop("source_size").join(
        goals.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    lines = lines.withColumnsRenamed({"source": "__source", "__range": "__of"})
    running = Window.partitionBy("source", "__range").orderBy("__hash", key, "size").rowsBetween(
        Window.unboundedPreceding, -1)
    started = placed.withColumn("__inside", F.coalesce(F.sum("size").over(running), F.lit(0)))
    joined = started.join(
        lines, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__of")))
    start = F.col("__before") + F.col("__inside")
    # Rounds p = 0, 1, ... with p * source_size + start + size / 2 < target.
    copies = F.ceil((F.col("target") - start - F.col("size") / 2) / F.col("source_size"))
    return joined.withColumns({
        "__start": start,
        "copies": F.when(F.col("size") > 0, F.greatest(copies, F.lit(0))).otherwise(0).cast("long"),
    }).drop("__hash", "__range", "__inside", "__before", "__source", "__of")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **mix) -> DataFrame:
    """(key, size, source_size, target, taken, source, copies, first_position) per row of `docs`.

    Size is the number of words; taken is size times copies. first_position is
    the training time of the first copy, NULL where there is none. Rows are
    sorted by it over the whole result, NULLs last. A NULL or empty text has no
    words and is never taken; repeated rows are rows of their own. Other columns
    are not read, whatever their names; an empty table gives an empty one.
    """
    sized = write_and_reread(
        docs.select(F.col(key), F.col(source).alias("source"), word_count(text).alias("size")), "sized")
    out = plan(sized, key, **mix)
    share = (F.col("__start") + F.col("size") / 2) / F.col("target")
    return out.select(
        key, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies",
        F.when(F.col("copies") > 0, position(share, F.col("shape"))).alias("first_position"),
    ).orderBy(F.asc_nulls_last("first_position"), key)


def training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **mix) -> DataFrame:
    """The rows of the mix, a row per copy, with the columns of `docs`, sorted by training position.

    Sizes and the plan are made on narrow rows; the documents, written once with
    a row number, join the plan by it and are then range-sorted.
    """
    stored = write_and_reread(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[key].alias("key"),
                    docs[source].alias("source"), word_count(docs[text]).alias("size"))
        .withColumn("row", F.monotonically_increasing_id()), "stored")
    planned = plan(stored.select("key", "source", "size", "row"), "key", **mix)
    rounds = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("round")
    share = (F.col("round") * F.col("source_size") + F.col("__start") + F.col("size") / 2) / F.col("target")
    places = (
        planned.filter("copies > 0").select("*", rounds)
        .select("row", "round", position(share, F.col("shape")).alias("position")))
    return stored.select("row", "doc").join(places, "row").orderBy("position", "row", "round").select("doc.*")
