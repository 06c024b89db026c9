"""Helpers shared by the operators on texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import workers_import, write_and_reread

# Fixed value: a word is a run of anything but the six ASCII white-space characters, as bytes.split() cuts.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 8 << 20
BATCH_BYTES = "16m"


def prepare(spark) -> None:
    """Let Python workers import the package, and hand them texts in batches of 16 MB, as they hold a batch several times over."""
    workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def word_count(text) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def as_bytes(array) -> list:
    """Texts of an Arrow column as UTF-8 bytes or None."""
    return array.cast(pa.binary()).to_pylist()


def slices(batch, column: str, most: int = SLICE_BYTES):
    """Parts of a record batch that hold about `most` bytes of the column, or one longer row."""
    length = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(length, dtype=np.int64) - length) // most
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(length)]):
        yield batch.slice(a, b - a)


def each_text(array, most: int = SLICE_BYTES):
    """Texts of an Arrow column one by one, as UTF-8 bytes or None, copied from the column a slice at a time."""
    for part in slices(pa.RecordBatch.from_arrays([array], ["text"]), "text", most):
        yield from as_bytes(part.column("text"))


def gather_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lengths[i]] of all i in one array."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def with_order(df: DataFrame, order, name: str) -> DataFrame:
    """Write the rows in a total order and add part (of the order) and idx (place within the part).

    The range exchange samples the keys and cuts the order into parts of like
    size, so no task sorts more than its share. The written table fixes parts
    and places: a later step that loses an executor reads the same ones again.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .withColumn("__place", place)
        .withColumns({"__part": F.shiftright("__place", 33), "__idx": F.col("__place").bitwiseAND((1 << 33) - 1)})
        .drop("__place")
    )
    return write_and_reread(placed, name)


def part_offsets(placed: DataFrame, amount: Column, by=()) -> DataFrame:
    """(by..., __part, __before, __all): the amount before a part, and in all parts; a row per part and `by`."""
    per_part = placed.groupBy(*by, "__part").agg(amount.alias("__amount"))
    whole = Window.partitionBy(*by)
    upto = F.sum("__amount").over(whole.orderBy("__part"))
    return per_part.select(*by, "__part", (upto - F.col("__amount")).alias("__before"),
                           F.sum("__amount").over(whole).alias("__all"))
