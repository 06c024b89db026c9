"""Shards as runs along a Hilbert curve through the metadata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import part_offsets, with_order
from tidemark.operators.bounded import lookup, stored
from tidemark.session import write_and_reread

BITS = 8


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (n, dimensions), 0 to 2^bits - 1 each.

    From the top bit down, a cell's quadrant decides how the smaller curve
    inside it is turned; undoing the turns leaves the Gray code of the place.
    """
    x = cells.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            up = (x[i] >> b) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = (place << 1) | ((row >> b) & 1)
    return place


def curve(*dimensions: Column, bits: int = BITS) -> Column:
    """Hilbert index of integer columns, each clipped to 0 to 2^bits - 1; NULL counts as 0."""

    @F.arrow_udf("long")
    def of(*columns: pa.Array) -> pa.Array:
        cells = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns], axis=1)
        return pa.array(hilbert_index(np.clip(cells, 0, (1 << bits) - 1), bits), pa.int64())

    return of(*[d.cast("long") for d in dimensions])


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, hilbert) of every row: equal runs of the curve's order.

    Dimensions are language, source and size, each cut into cells that follow its
    order and hold about as many rows each, so that the least and greatest value
    of a shard tell what it cannot hold. Rows are sorted by curve index, then key, checksum, size, language and source, and
    cut into `shards` runs whose row counts differ by one at most; slot is the
    place in the run. Rows that agree in all of these are interchangeable. A NULL
    text has no bytes, a text of any length is one row, and other columns are not
    read; an empty table gives an empty one. The
    order is cut by sampling into parts of like size and numbered from their
    counts, so no cell of the curve, however full, is a task of its own.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = write_and_reread(docs.select(
        F.col(key), size.alias("size"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.col(lang).alias("__lang"), F.col(source).alias("__source")), "narrow")
    dimensions = ["__lang", "__source", "size"]
    for c in dimensions:
        rows = with_cell(rows, c)
    rows = rows.withColumn("hilbert", curve(*[F.col(f"__cell_{c}") for c in dimensions])).drop(*[f"__cell_{c}" for c in dimensions])
    placed = with_order(rows, ["hilbert", key, "text_crc32", "size", "__lang", "__source"], "curve")
    offsets = part_offsets(placed, F.count("*"))
    rank, n = F.col("__before") + F.col("__idx"), F.col("__all")
    # Shard s starts at rank ceil(s * n / shards).
    at = F.expr(f"bigint(__rank * {shards} div __all)")
    return (
        placed.join(offsets, "__part").withColumn("__rank", rank).withColumn("__shard", at)
        .select(key, "size", "text_crc32", F.lit("rows").alias("law"), F.col("__shard").cast("int").alias("shard"),
                (F.col("__rank") - F.ceil(F.col("__shard") * n / shards)).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"), "hilbert"))


def with_cell(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Add __cell_<column>: where the value's rows lie in the order of all values, in 2^bits steps.

    Equal values share the cell of their middle row; NULL comes first. Values
    are counted before they are ordered, and numbered by parts of the order.
    """
    counts = with_order(rows.groupBy(column).agg(F.count("*").alias("n")), [column], "values")
    inside = F.sum("n").over(Window.partitionBy("__part").orderBy("__idx")) - F.col("n")
    middle = F.col("__before") + F.col("__inside") + (F.col("n") - 1) / 2
    cells = stored(counts.withColumn("__inside", inside).join(part_offsets(counts, F.sum("n")), "__part").select(
        column, F.floor(middle * (1 << bits) / F.col("__all")).cast("int").alias(f"__cell_{column}")))
    return lookup(rows, cells, [column], "left")


def manifest(sharded: DataFrame, columns) -> DataFrame:
    """Rows, bytes and the least and greatest value of each column per shard, for skipping whole shards."""
    edges = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *edges)
