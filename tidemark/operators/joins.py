"""Left joins that survive a hot key on either side, and stores laid out so that they join in place."""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from tidemark.operators.bounded import lookup, stored
from tidemark.sources import files

HOT_ROWS = 1_000_000
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS = 8
SLOT, PARTS, HERE = "__slot", "__parts", "__here"


def hot_keys(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, a, b): keys with more than `hot_rows` rows on a side, and into how many parts each side is cut.

    Reads the key columns only. There are at most rows / hot_rows such keys.
    """
    def parts(df, name):
        return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).filter(
            F.col("__n") > hot_rows).select(key, F.ceil(F.col("__n") / hot_rows).cast("int").alias(name))

    one = F.lit(1)
    return parts(left, "a").join(parts(right, "b"), key, "full").select(
        key, F.coalesce("a", one).alias("a"), F.coalesce("b", one).alias("b"))


def _dealt(df: DataFrame, hot: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """Rows with their key's parts, dealt to one of their own side's parts and copied to each part of the other side.

    A row's part comes from what it holds, so a task that runs again after an
    executor is lost deals it the same way.
    """
    parts = hot.withColumnsRenamed({"a": "__a", "b": "__b"})
    known = lookup(df, parts, [key], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("__a", "__b")})
    content = F.xxhash64(*[F.col(f.name) for f in df.schema if not isinstance(f.dataType, MapType)])
    return known.withColumn("__own", F.pmod(content, F.col(own)).cast("int")).withColumn(
        "__other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))


def deal_left(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Add the slot in which a left row meets right rows; one copy for each part of the right."""
    return _dealt(df, hot, key, "__a", "__b").withColumns(
        {SLOT: F.expr("__own * __b + __other"), PARTS: F.col("__b")}).drop("__a", "__b", "__own", "__other")


def deal_right(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Add the slot in which a right row meets left rows; one copy for each part of the left."""
    return _dealt(df, hot, key, "__b", "__a").withColumn(SLOT, F.expr("__other * __b + __own")).withColumn(
        HERE, F.lit(True)).drop("__a", "__b", "__own", "__other")


def join_dealt(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The left join of dealt sides.

    A left row of a key that is cut on the right has a copy in each part and a
    match in some; copies in parts without one are dropped. A key that is not cut
    has one copy, which stays without a match.
    """
    joined = left.join(right, [key, SLOT], "left")
    return joined.filter(f"{HERE} or {PARTS} = 1").drop(SLOT, PARTS, HERE)


def left_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`left` with all matches of `right`, NULLs where there is none; one outer join, each side read once by it.

    Adaptive execution splits a key of an outer join on its left only. Here hot
    keys are counted first, from the key columns, and cut into parts of
    `hot_rows` on either side; rows of the other side go to every part. The cut
    is a grid, so a key that is hot on both sides spreads over all its cells.
    """
    hot = stored(hot_keys(left, right, key, hot_rows))
    return join_dealt(deal_left(left, hot, key), deal_right(right, hot, key), key).select(
        *left.columns, *[c for c in right.columns if c != key])


class Colocated:
    """Two stores laid out by key and slot in the same buckets, so that their left join moves no row.

        ROOT/left, ROOT/right    bucketed and sorted by key and slot
        ROOT/hot                 the hot keys and their parts, fixed when the stores are first laid out
        ROOT/layout.json         key, buckets and columns

    Rows may be added later; they are dealt by the same hot keys. A key that has
    become hot since then is still joined right, in one task, until the stores
    are laid out anew.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _layout(self) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.root}/layout.json"))

    def _table(self, side: str) -> str:
        return f"tidemark_{side}_{hashlib.md5(self.root.encode()).hexdigest()}"

    def _write(self, df: DataFrame, side: str, key: str, buckets: int) -> None:
        keys = [key, SLOT]
        df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.bucketBy(buckets, *keys).sortBy(*keys).option(
            "path", f"{self.root}/{side}").format("parquet").mode("append").saveAsTable(self._table(side))

    def lay_out(self, left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS,
                bucket_rows: int = BUCKET_ROWS, least_buckets: int = LEAST_BUCKETS) -> Colocated:
        """Write both sides for the first time; the number of buckets comes from the rows of the larger one."""
        hot_keys(left, right, key, hot_rows).write.parquet(f"{self.root}/hot")
        rows = max(left.count(), right.count())
        buckets = max(least_buckets, math.ceil(rows / bucket_rows))
        self._write(deal_left(left, self.hot(), key), "left", key, buckets)
        self._write(deal_right(right, self.hot(), key), "right", key, buckets)
        layout = {"key": key, "buckets": buckets, "left": left.schema.jsonValue(), "right": right.schema.jsonValue()}
        files.create_if_absent(self.spark, f"{self.root}/layout.json", json.dumps(layout))
        return self

    def hot(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/hot")

    def add(self, df: DataFrame, side: str) -> None:
        """More rows of one side, dealt like those before."""
        layout = self._layout()
        deal = deal_left if side == "left" else deal_right
        self._open(side)
        self._write(deal(df, self.hot(), layout["key"]), side, layout["key"], layout["buckets"])

    def _open(self, side: str) -> str:
        """The table of a side, made known to this session with its buckets where it is not."""
        name, layout = self._table(side), self._layout()
        if not self.spark.catalog.tableExists(name):
            fields = StructType.fromJson(layout[side]).fields
            extra = [f"{SLOT} int", f"{PARTS} int" if side == "left" else f"{HERE} boolean"]
            body = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], *extra])
            keys = f"`{layout['key']}`, {SLOT}"
            self.spark.sql(
                f"create table {name} ({body}) using parquet clustered by ({keys}) sorted by ({keys}) "
                f"into {layout['buckets']} buckets location '{self.root}/{side}'")
        return name

    def read(self, side: str) -> DataFrame:
        """A side as it is laid out, with slots."""
        return self.spark.table(self._open(side))

    def join(self, where=None, columns=None) -> DataFrame:
        """The left join, of the left rows that fulfil a condition and with the given right columns; no row is moved."""
        layout = self._layout()
        left, right = self.read("left"), self.read("right")
        if where is not None:
            left = left.filter(where)
        own = [c for c in layout["right"]["fields"] if c["name"] != layout["key"]]
        names = [c["name"] for c in own] if columns is None else list(columns)
        joined = join_dealt(left.hint("merge"), right.select(layout["key"], SLOT, HERE, *names), layout["key"])
        return joined.select(*[f["name"] for f in layout["left"]["fields"]], *names)
