"""Exact, repeatable splits by label without sorting a whole label in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bounded import lookup, running_total, stored

PREFIX = 3


def _key_order(keys, seed: int) -> Column:
    """Pseudo-random order of the rows: the hash of the key, then the key.

    Parts of a key are set apart by bars; bars and backslashes inside a part are
    escaped and NULL is written as \\N, so different keys never read the same.
    """
    part = r"coalesce(replace(replace(string(`{}`), r'\', r'\\'), '|', r'\|'), r'\N')"
    text = "concat_ws('|', " + ", ".join(part.format(k) for k in keys) + ")"
    return F.expr(f"struct(md5(concat('{seed}|', {text})) as hash, {text} as key)")


def _sections(df: DataFrame, label: str, keys, seed: int, limits: list[str]) -> DataFrame:
    """Add `section`: how many of the rank limits each row lies beyond.

    `limits` are SQL expressions of n, the rows of the label. Rows of a label
    are ranked by key hash. Counting rows per hash prefix (16^3 per label) tells
    which prefix holds each limit; only those are ranked key by key, by many tasks.
    The keys at the limits then stand for the ranks: every row is compared with
    them in place, so the rows themselves are never shuffled. Rows that share a
    key stay in one section, so sizes are exact where the key is unique.
    """
    marked = df.withColumn("__at", _key_order(keys, seed))
    prefix = F.substring("__at.hash", 1, PREFIX).alias("prefix")
    whole = Window.partitionBy(label)
    wanted = ", ".join(f"struct({i} as i, bigint({e}) as rank)" for i, e in enumerate(limits))
    inside = (
        marked.groupBy(label, prefix).agg(F.count("*").alias("rows"))
        .withColumns({"upto": F.sum("rows").over(whole.orderBy("prefix")), "n": F.sum("rows").over(whole)})
        .select(label, "prefix", F.expr("upto - rows as below"),
                F.expr(f"filter(array({wanted}), w -> w.rank > upto - rows and w.rank <= upto) as wanted"))
        .filter("size(wanted) > 0")
    )
    inside = stored(inside)
    # Counting per key first keeps any number of copies of one key to one row.
    keyed = (
        lookup(marked.select(label, "__at", prefix), inside, [label, "prefix"], "left_semi")
        .groupBy(label, "prefix", "__at").agg(F.count("*").alias("rows"))
    )
    ends = (
        lookup(running_total(keyed, [label, "prefix"], "__at", "rows", "upto"), inside, [label, "prefix"]).withColumn("upto", F.expr("upto + below"))
        .select(label, "__at", F.expr("inline(filter(wanted, w -> w.rank > upto - rows and w.rank <= upto))"))
        .groupBy(label).agg(F.expr("map_from_entries(collect_list(struct(i, __at)))").alias("__ends"))
    )
    beyond = " + ".join(f"int(coalesce(__at > try_element_at(__ends, {i}), true))" for i in range(len(limits)))
    return (
        lookup(marked, stored(ends), [label], "left")
        .withColumn("section", F.expr(beyond)).drop("__at", "__ends")
    )


def stratified_split(df: DataFrame, label: str, keys, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Add `split`: floor(train_ratio * n) rows of each label are "train", the rest "test"."""
    out = _sections(df, label, keys, seed, [f"floor(n * {float(train_ratio)!r}D)"])
    return out.withColumn("split", F.when(F.col("section") == 0, "train").otherwise("test")).drop("section")


def stratified_folds(df: DataFrame, label: str, keys, folds: int = 3, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add the fold number; fold sizes within a label differ by one at most."""
    limits = [f"(n div {folds}) * {i} + least(n % {folds}, {i}L)" for i in range(1, folds)]
    return _sections(df, label, keys, seed, limits).withColumnRenamed("section", name)
