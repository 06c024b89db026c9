"""Passages that repeat word for word, found through anchors at the positions of a difference cover."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh3_64_intdigest

from tidemark.llm.common import as_bytes, each_text, part_offsets, slices, with_order
from tidemark.session import scratch_path, scratch_scope, write_and_reread

# Perfect difference sets. Any two positions have a shift below the period that takes both onto the set.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
# Odd multipliers of the rolling hashes; the first also hashes anchors.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
KNOWN_WORDS = 200_000
SLICE = 2 << 20  # bytes of text whose words a task holds at once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cover_of(length: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, words of an anchor) for matches of `length` words: the longest period up to two thirds of it."""
    period = max(p for p in COVERS if p == 1 or 3 * p <= 2 * length)
    return period, COVERS[period], length - period + 1


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxh3_64_intdigest(word)
        return found


class Words:
    """The words of several texts one after another, as hashes, with the place and length of each text."""

    def __init__(self, texts, known: WordHashes):
        self.words = [t.split() if t else [] for t in texts]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        total = int(self.lengths.sum())
        self.flat = np.fromiter((known[w] for words in self.words for w in words), np.uint64, total)
        self.text = np.repeat(np.arange(len(self.words)), self.lengths)
        self.place = np.arange(total) - self.starts[self.text]

    def windows(self, width: int, multiplier: int) -> np.ndarray:
        """The rolling hash of the `width` words from each position on; zeros where fewer are left at the very end."""
        out = np.zeros(len(self.flat), np.uint64)
        if len(out) >= width:
            powers = np.full(len(out), multiplier, np.uint64)
            powers[0] = 1
            sums = np.concatenate([[np.uint64(0)], np.cumsum(self.flat * np.multiply.accumulate(powers), dtype=np.uint64)])
            powers[1:] = pow(multiplier, -1, 1 << 64)
            count = len(out) - width + 1
            out[:count] = (sums[width:] - sums[:count]) * np.multiply.accumulate(powers)[:count]
        return out

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors: windows at cover positions that lie within their text."""
        period, cover, width = cover_of(length)
        on = np.zeros(period, bool)
        on[list(cover)] = True
        fits = self.place + width <= self.lengths[self.text]
        at = np.flatnonzero(fits & on[self.place % period] & (self.lengths[self.text] >= length))
        return at, self.windows(width, MULTIPLIERS[0])[at]

    def in_text(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """One number for a hash and the text in which it stands."""
        return hashes ^ (self.text[at].astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[1])


def sequence_hash(words: list[bytes]) -> bytes:
    return xxh3_128_digest(b" ".join(words))


def _two_longs(digests: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]


def _describe(length: int):
    def run(batches):
        known, seen = WordHashes(), set()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(as_bytes(part.column("text")), known)
                digests = [sequence_hash(w) for w in words.words]
                fresh = np.zeros(len(digests), bool)
                for i, d in enumerate(digests):
                    if d not in seen:
                        seen.add(d)
                        fresh[i] = True
                at, hashes = words.anchors(length)
                hashes, text = hashes[fresh[words.text[at]]], words.text[at][fresh[words.text[at]]]
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                again = np.zeros(len(text), bool)
                again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
                local = np.bincount(text[again], minlength=len(digests)) > 0
                hashes, text = hashes[~again], text[~again]
                edges = np.searchsorted(text, np.arange(len(digests) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), *_two_longs(digests), pa.array(words.lengths), pa.array(local),
                     pa.ListArray.from_arrays(edges, hashes.view(np.int64))],
                    ["key", "hi", "lo", "n_words", "local", "anchors"])

    return run


def described(docs: DataFrame, length: int) -> DataFrame:
    """(key, hi, lo, n_words, local, anchors) of each row of (key, text).

    hi and lo hash the sequence of words. The anchors are told once per task and
    sequence, each hash once per text; local says that the text holds one of its
    anchors twice.
    """
    key = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(
        _describe(length), f"key {key}, hi long, lo long, n_words long, local boolean, anchors array<long>")


def sequence(text: Column) -> Column:
    """(hi, lo) of the words of a text, as `described` tells them."""
    @F.arrow_udf("hi long, lo long")
    def of(column: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_two_longs([sequence_hash(t.split() if t else []) for t in each_text(column)]), ["hi", "lo"])

    # Told as not repeatable, so that it is computed once before a join.
    return of.asNondeterministic()(text)


def _windows(length: int):
    """Windows (h1, h2, base, start) of texts around their repeated anchors.

    An anchor that occurs again extends by up to a period less one word to the
    left and as far to the right as a window needs, within its text.
    """
    period, _, width = cover_of(length)

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(as_bytes(part.column("text")), known)
                at, hashes = words.anchors(length)
                own = words.in_text(at, hashes)
                given = part.column("anchors")
                many = np.array([len(x) if x is not None else 0 for x in given.to_pylist()], np.int64)
                listed = given.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                there = listed ^ (np.repeat(np.arange(len(many)), many).astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[1])
                _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
                at = at[(counts[inverse] > 1) | np.isin(own, there)] if len(at) else at
                first, last = words.starts[words.text[at]], (words.starts + words.lengths - length)[words.text[at]]
                low, high = np.maximum(first, at - period + 1), np.minimum(last, at)
                size = len(words.flat) + 1
                open_ = np.cumsum(np.bincount(low, minlength=size) - np.bincount(high + 1, minlength=size))
                start = np.flatnonzero(open_[:-1] > 0)
                base = part.column("base").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(words.windows(length, m)[start].view(np.int64)) for m in MULTIPLIERS],
                     pa.array(base[words.text[start]]), pa.array(words.place[start].astype(np.int32))],
                    ["h1", "h2", "base", "start"])

    return run


@contextmanager
def shuffles_released(spark: SparkSession):
    """Let Spark delete the shuffle files of each execution when it ends; steps here meet in written tables only."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _same(a: DataFrame, b: DataFrame, names=("hi", "lo", "key")):
    """Rows of one key and one sequence of words; NULL keys are one key."""
    (hi, lo, key) = names
    return (a[hi] == b["hi"]) & (a[lo] == b["lo"]) & a[key].eqNullSafe(b["key"])


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 20) -> DataFrame:
    """(key, hi, lo, spans) of each distinct pair of a key and a sequence of words in which words are repeats.

    A window is `length` consecutive words of one text. spans are the stretches
    (first, last), words counted from 0, that are covered by windows whose words
    also start earlier: in a text with a smaller key, or earlier in the same
    one. Words are cut at ASCII white space and compared as they are; a NULL text
    has none. A NULL key comes after all others; texts of one key come in the
    order of their hashes, and rows with the same key and the same words are one
    text, as are those of NULL keys.

    Of texts with the same words only that with the smallest key is searched;
    all windows of the others start there. Two equal windows share an anchor at
    a cover position of both, so windows are hashed in full only around anchors
    that occur again: in another text or elsewhere in the same one. Windows are
    compared by 128 bits, and the first of each hash stays. Anchors and windows
    meet in aggregations that combine before the shuffle and in joins that split
    hot keys; lists are held per text only, and are no longer than it. All steps
    end in written tables, of which the spans stay. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    path = scratch_path(spark, "spans")
    with shuffles_released(spark), scratch_scope(spark):
        rows = write_and_reread(described(named, length), "anchors")
        whole = rows.filter(F.col("n_words") >= length).groupBy("hi", "lo").agg(
            F.min("key").alias("key"), F.first("n_words").alias("n_words"), F.bool_or("local").alias("local"))
        placed = with_order(whole, [F.col("key").isNull(), "key", "hi", "lo"], "order")
        upto = Window.partitionBy("__part").orderBy("__idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        firsts = write_and_reread(
            placed.withColumn("base", F.sum("n_words").over(upto) - F.col("n_words"))
            .join(part_offsets(placed, F.sum("n_words")), "__part")
            .select("hi", "lo", "key", "n_words", "local", (F.col("base") + F.col("__before")).alias("base")), "firsts")

        anchors = rows.select("hi", F.explode("anchors").alias("anchor"))
        again = write_and_reread(
            anchors.groupBy("anchor").agg(F.min("hi").alias("a"), F.max("hi").alias("b")).filter("a <> b").select("anchor"),
            "again")
        found = write_and_reread(
            anchors.join(again, "anchor", "left_semi").groupBy("hi").agg(F.collect_set("anchor").alias("anchors")), "found")
        search = firsts.join(found, "hi", "left").filter("local or anchors is not null")
        texts = named.withColumn("seq", sequence(F.col("text"))).select(
            F.col("seq.hi").alias("t_hi"), F.col("seq.lo").alias("t_lo"), F.col("key").alias("t_key"), "text")
        windows = write_and_reread(
            texts.join(search, _same(texts, search, ("t_hi", "t_lo", "t_key"))).select("text", "base", "anchors")
            .mapInArrow(_windows(length), "h1 long, h2 long, base long, start int"), "windows")

        at = F.col("base") + F.col("start")
        leaders = write_and_reread(
            windows.groupBy("h1", "h2").agg(F.min(at).alias("least"), F.max(at).alias("most"))
            .filter("least < most").drop("most"), "leaders")
        starts = windows.join(leaders, ["h1", "h2"]).filter(at > F.col("least")).groupBy("base").agg(
            F.array_sort(F.collect_set("start")).alias("starts"))
        inside = firsts.join(starts, "base").select("hi", "lo", "key", _merged("starts", length).alias("spans"))
        copies = (
            rows.filter(F.col("n_words") >= length).groupBy("key", "hi", "lo").agg(F.first("n_words").alias("n_words"))
            .join(firsts.select("hi", "lo", F.col("key").alias("least")), ["hi", "lo"])
            .filter(~F.col("key").eqNullSafe(F.col("least")))
            .select("hi", "lo", "key", F.expr("array(struct(0 as first, int(n_words) - 1 as last))").alias("spans")))
        found = inside.unionByName(copies).select("key", "hi", "lo", "spans")
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _merged(starts: str, length: int) -> Column:
    """Stretches of words covered by the windows at sorted starts."""
    edge = f"filter(sequence(1, size({starts}) - 1), i -> {starts}[i] > {starts}[i - 1] + {length})"
    begin = f"concat(array({starts}[0]), if(size({starts}) < 2, cast(array() as array<int>), transform({edge}, i -> {starts}[i])))"
    end = (f"concat(if(size({starts}) < 2, cast(array() as array<int>), transform({edge}, i -> {starts}[i - 1])), "
           f"array({starts}[size({starts}) - 1]))")
    return F.expr(f"zip_with({begin}, {end}, (a, b) -> named_struct('first', a, 'last', b + {length - 1}))")


CUT_SCHEMA = "n_words long, n_removed long, text string"


def without(text: Column, spans: Column) -> Column:
    """(n_words, n_removed, text): the words outside the spans, joined by one space."""
    @F.arrow_udf(CUT_SCHEMA)
    def of(texts: pa.Array, given: pa.Array) -> pa.Array:
        n, removed, kept = [], [], []
        for t, cuts in zip(each_text(texts), given.to_pylist()):
            words = t.split() if t else []
            n.append(len(words))
            if cuts:
                left, at = [], 0
                for c in cuts:
                    left += words[at:c["first"]]
                    at = c["last"] + 1
                words = left + words[at:]
            removed.append(n[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_words", "n_removed", "text"])

    return of.asNondeterministic()(text, spans)


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 20) -> DataFrame:
    """Add the column cut: (n_words, n_removed, text) without the repeats that `repeats` finds.

    All rows and columns stay; a column named cut is replaced.
    """
    spans = repeats(docs, key, text, length).select("hi", "lo", F.col("key"), F.col("spans").alias("__spans"))
    told = docs.withColumn("__seq", sequence(F.col(text))).withColumns(
        {"__hi": F.col("__seq.hi"), "__lo": F.col("__seq.lo")}).drop("__seq")
    names = spans.withColumnsRenamed({"hi": "__h", "lo": "__l", "key": "__k"})
    match = (told["__hi"] == names["__h"]) & (told["__lo"] == names["__l"]) & told[key].eqNullSafe(names["__k"])
    return told.join(names, match, "left").withColumn("cut", without(F.col(text), F.col("__spans"))).select(
        *[c for c in docs.columns if c != "cut"], "cut")
