"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import gather_runs
from tidemark.session import write_and_reread


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 0) -> np.ndarray:
    """(dimensions, bits): principal axes turned so that the signs lose least.

    Signs and the best rotation onto them are set in turn from a random start.
    At most one bit per dimension.
    """
    _, axes = np.linalg.eigh(sample.T @ sample)
    axes = axes[:, ::-1][:, :bits]
    flat = sample @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (u @ v).T
    return axes @ turn


def substrings(vectors: np.ndarray, rotation: np.ndarray, width: int) -> np.ndarray:
    """(n, cuts): the code of each vector, cut into integers of `width` bits; the last may be shorter."""
    bits = vectors @ rotation > 0
    cuts = -(-bits.shape[1] // width)
    wide = np.zeros((len(bits), cuts * width), bool)
    wide[:, :bits.shape[1]] = bits
    return (wide.reshape(len(bits), cuts, width) << np.arange(width)).sum(axis=2)


@lru_cache
def masks_within(width: int, radius: int) -> np.ndarray:
    """All integers of `width` bits with `radius` ones or fewer."""
    return np.array([sum(1 << i for i in c) for n in range(min(radius, width) + 1) for c in combinations(range(width), n)])


class Block:
    """Codes of some rows, indexed once per substring."""

    def __init__(self, codes: np.ndarray, width: int):
        self.codes, self.width = codes, width
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.edges = [np.searchsorted(c[o], np.arange((1 << width) + 1)) for c, o in zip(codes.T, self.order)]
        self.found = np.zeros(len(codes), bool)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes at `radius` bits or fewer.

        By the pigeonhole principle one of the substrings of such a code differs
        in radius // cuts bits at most, so these probes miss none.
        """
        masks = masks_within(self.width, radius // self.codes.shape[1])
        self.found[:] = False
        for cut, part in enumerate(code):
            edges, buckets = self.edges[cut], part ^ masks
            self.found[gather_runs(self.order[cut], edges[buckets], edges[buckets + 1] - edges[buckets])] = True
        at = np.flatnonzero(self.found)
        return at[np.bitwise_count(self.codes[at] ^ code).sum(axis=1) <= radius]


def nearest(embeddings: DataFrame, is_query, k: int = 20, radius: int = 31, bits: int = 64, width: int = 8,
            sample: int = 20_000, rows_per_block: int = 8_192, queries_per_lot: int = 1_024, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product found for each query.

    `is_query` is a condition on the key. The rotation is learnt from about
    `sample` vectors chosen by hash, which the driver gathers; every row is
    indexed. Rows and queries are dealt into blocks by hash; each pair of a
    query block and a row block is one task's work: the block's substrings are
    indexed, each query probes the buckets that the radius allows, codes beyond
    it fall out, and the rest are ranked by inner products of the vectors in
    double precision, ties to the smaller key. Where a block holds fewer than k
    codes in the radius, it is widened until k are found or the block is
    through, so a query always gets k rows if there are as many. Only k rows
    per query and block leave the task.

    Vectors that are NULL, all zero, or hold NULL or non-finite components, rows
    without a key, and vectors whose length is not the commonest (the longer of
    two) take no part. A key that repeats is asked once, with the smallest of its
    vectors by array order, in every block; none of its rows is a candidate.
    """
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col(key).isNotNull() & sound & F.exists(vector, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    total = sizes["n"]
    blocks = -(-total // rows_per_block)
    rows = write_and_reread(
        rows.filter(F.size("vector") == sizes["d"]).withColumn(
            "block", F.pmod(F.xxhash64(F.lit("block"), "id", "vector"), F.lit(blocks)).cast("int")), "vectors")
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(total)) < sample)
    learnt = np.array(drawn.select("vector").limit(2 * sample).toPandas()["vector"].tolist(), float).reshape(-1, sizes["d"])
    if len(learnt) < 2:
        learnt = np.array([rows.select("vector").first()[0]] * 2, float)
    rotation = learn_rotation(learnt, bits)
    queries = rows.filter(is_query(F.col("id"))).groupBy("id").agg(F.min("vector").alias("vector"))
    lots = max(1, -(-queries.count() // queries_per_lot))
    dealt = queries.withColumn("lot", F.pmod(F.xxhash64(F.lit("lot"), "id"), F.lit(lots)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            vectors = np.array(held["vector"].tolist())
            ids = held["id"].to_numpy()
            block = Block(substrings(vectors, rotation, width), width)
            wanted = np.array(asked["vector"].tolist())
            for one, vec, code in zip(asked["id"].to_numpy(), wanted, substrings(wanted, rotation, width)):
                reach = radius
                at = block.within(code, reach)
                while (ids[at] != one).sum() < k and reach < rotation.shape[1]:
                    reach += 4
                    at = block.within(code, reach)
                at = at[ids[at] != one]
                score = (vectors[at] * vec).sum(axis=1)
                if len(at) > k:
                    near = score >= -np.partition(-score, k - 1)[k - 1]
                    at, score = at[near], score[near]
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"query_id": one, "vec_id": ids[at[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = dealt.groupBy("lot", "block").cogroup(spread.groupBy("lot", "block")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
