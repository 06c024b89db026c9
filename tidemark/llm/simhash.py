"""Near-duplicates by SimHash fingerprints, found through signatures with one bit left out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from tidemark.llm.common import each_text
from tidemark.session import write_and_reread

BITS = 64
SEED = 42
COUNTED = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit integer; zero without words.

    A-Z are lowered, words are cut at ASCII white space, and each run of
    `shingle` words, repeats included, is hashed by XXH64 with seed 42. A bit is
    set where over half the hashes have it. A shorter text is one run.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashed = xxh64_digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        runs = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        hashed = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in runs])
    rows = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(rows), COUNTED):
        ones += np.unpackbits(rows[i:i + COUNTED], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the SimHash of the whole text of each row as a long."""

    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in each_text(column)], pa.int64())

    return docs.withColumn(name, of(text))


def links(prints: DataFrame, distance: int = 2, name: str = "fingerprint") -> DataFrame:
    """(a, b), a < b as signed longs: all pairs of the distinct fingerprints that differ in `distance` bits or fewer.

    The bits are cut into distance // 2 + 1 segments, so that of a pair one
    segment differs in at most one bit. Each segment is indexed as it is, and
    with each of its bits left out in turn; a fingerprint with a 0 there meets
    those with a 1. An equality join over these signatures finds the candidates,
    and the join's condition counts the bits of the whole. Of several segments
    that would find a pair only the first does, so no pair comes twice. Later
    segments need fewer signatures, as all earlier ones differ in two bits at least.
    """
    cuts = distance // 2 + 1
    width = -(-BITS // cuts)
    spans = [(s * width, min(BITS, (s + 1) * width) - s * width) for s in range(cuts)]

    def masked(size: int) -> int:
        return (1 << size) - 1 if size < 64 else -1

    def segment(x: str, s: int) -> str:
        at, size = spans[s]
        return f"(shiftrightunsigned({x}, {at}) & {masked(size)}L)"

    def signatures(side: str, bit: int) -> DataFrame:
        exact = ", ".join(f"struct({s} as cut, -1 as hole, {segment(name, s)} as value)" for s in range(cuts))
        wild = []
        for s, (_, size) in enumerate(spans):
            if 2 * s + 1 <= distance:
                seg = segment(name, s)
                wild.append(
                    f"transform(filter(sequence(0, {size - 1}), i -> (shiftrightunsigned({seg}, i) & 1L) = {bit}), "
                    f"i -> struct({s} as cut, i as hole, {seg} & ~shiftleft(1L, i) as value))")
        every = "array(" + exact + ")" if not wild else f"concat(array({exact}), {', '.join(wild)})"
        return prints.select(F.col(name).alias(side), F.expr(f"inline({every})"))

    low, high = signatures("x", 0), signatures("y", 1)
    near = F.expr(f"bit_count(x ^ y) <= {distance} and (hole >= 0 or x < y)")
    first = [f"(cut <= {s} or bit_count({segment('(x ^ y)', s)}) > 1)" for s in range(cuts - 1)]
    joined = low.join(
        high.withColumnsRenamed({"cut": "cut_y", "hole": "hole_y", "value": "value_y"}),
        F.expr("cut = cut_y and hole = hole_y and value = value_y") & near & F.expr(" and ".join(first) or "true"))
    return joined.select(F.expr("least(x, y) as a"), F.expr("greatest(x, y) as b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node that can be reached.

    Each round a node takes the smallest root among its own and its
    neighbours', then the root of that root; rounds end when none changes.
    Rounds are written tables, so a lost executor costs no earlier round.
    """
    both = write_and_reread(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))), "edges")
    roots = write_and_reread(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.filter("moved").isEmpty():
        seen = roots.select(F.col("node").alias("other"), "root")
        hooked = both.join(seen, "other").groupBy("node").agg(F.min("root").alias("reached"))
        nearer = (
            roots.select("node", F.col("root").alias("old")).join(hooked, "node")
            .select("node", "old", F.least("old", "reached").alias("parent")))
        jumped = nearer.join(roots.select(F.col("node").alias("parent"), F.col("root").alias("above")), "parent")
        roots = write_and_reread(
            jumped.select("node", F.least("parent", "above").alias("root"))
            .join(roots.select("node", F.col("root").alias("old")), "node")
            .select("node", "root", (F.col("root") != F.col("old")).alias("moved")), "roots")
    return roots.select("node", "root")


def near_duplicates(prints: DataFrame, key: str = "doc_id", distance: int = 2, name: str = "fingerprint") -> DataFrame:
    """(fingerprint, component_id) per distinct fingerprint: the smallest key of all rows that links reach.

    `prints` needs the columns `key` and `name`, and should be a written table,
    as it is read more than once. Rows with one fingerprint link to each other
    at distance zero and count as one node. A NULL key loses to any other.
    """
    nodes = write_and_reread(prints.groupBy(name).agg(F.min(key).alias("least")), "fingerprints")
    roots = components(links(nodes.select(name), distance, name))
    rooted = nodes.join(roots.withColumnRenamed("node", name), name, "left").select(
        name, "least", F.coalesce("root", name).alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select(name, "component_id", "root")


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with the columns of `docs`: the one with the smallest key.

    Among rows with one key the one written first stays; NULL keys come last.
    The rows with their fingerprints are written once, which also numbers them.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[key].alias("key"), docs[text].alias("text"))
    stored = write_and_reread(
        with_fingerprint(whole, shingle).select("doc", "key", "fingerprint")
        .withColumn("row", F.monotonically_increasing_id()), "printed")
    groups = near_duplicates(stored.select("key", "fingerprint"), "key", distance)
    placed = stored.select("key", "row", "fingerprint").join(groups.select("fingerprint", "root"), "fingerprint")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("first")
    stay = placed.groupBy("root").agg(first).select("first.row")
    return stored.join(stay, "row", "left_semi").select("doc.*")
