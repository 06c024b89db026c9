"""How far the sources of a language lie apart in their words, by sparse row accumulation over a term-major index."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import each_text
from tidemark.session import write_and_reread

UNIT = 1_000_000_000
HELD = 300_000  # (group, term) counts that a task holds before it passes them on
BLOCK = 131_072  # postings of an index block
STEP = 1 << 20  # pairs of numbers in one numpy step

# Bytes of ASCII letters, lowered, and of all other characters; the rest are blanks.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS_SCHEMA = "lang string, source string, term string, n long, docs long"


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, with A-Z lowered."""
    return text.translate(_TERM_BYTES).split() if text else []


def _emit(counts, docs):
    rows = [(lang, source, t, n, docs[lang, source][t]) for (lang, source), found in counts.items() for t, n in found.items()]
    lang, source, term, n, d = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang), pa.array(source), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
         pa.array(d, pa.int64())], ["lang", "source", "term", "n", "docs"])


def _count(batches):
    counts, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for group, text in zip(groups, each_text(batch.column("text"))):
            found = Counter(terms(text))
            before = len(docs[group])
            counts[group].update(found)
            docs[group].update(found.keys())
            held += len(docs[group]) - before
            if held >= HELD:
                yield _emit(counts, docs)
                counts, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    if held:
        yield _emit(counts, docs)


def term_index(docs: DataFrame, least_docs: int = 10) -> DataFrame:
    """(lang, term, n, postings) of each term in at least `least_docs` documents of its language.

    `docs` has lang, source and text. Occurrences and documents are counted per
    task first, so a word of every document reaches the shuffle once per task,
    language and source. The postings (source, n) of a term have at most one
    element per source.
    """
    counted = docs.mapInArrow(_count, COUNTS_SCHEMA).repartition("lang", "term")
    per_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        per_source.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("postings"))
        .filter(F.col("docs") >= least_docs).drop("docs")
    )


def _share(n: str, whole: str) -> str:
    """1 + floor(UNIT * (n + 2) / whole), exact at any count that a long holds."""
    return f"1 + (cast({UNIT} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast(greatest({whole}, 1L) as decimal(20,0))"


def _gap(p, q):
    return (p - q) * (p - q) // (p + q)


def _group_stats(docs: DataFrame, index: DataFrame) -> DataFrame:
    """A row per (lang, source) that occurs: its place g among the sources of its language, counts and zero share.

    whole is the denominator of the group's shares, n_terms its terms with a
    count, kept the terms of the language, lang_whole the language's denominator.
    """
    langs = index.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("kept"))
    own = index.select("lang", F.explode("postings").alias("p")).groupBy("lang", "p.source").agg(
        F.sum("p.n").alias("n"), F.count("*").alias("n_terms"))
    numbered = docs.select("lang", "source").distinct().withColumn(
        "g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    stats = numbered.join(langs, "lang", "left").join(own, ["lang", "source"], "left").fillna(
        0, ["lang_n", "kept", "n", "n_terms"])
    return stats.select(
        "lang", "source", "g", "kept", "n_terms", F.expr("n + 2 * kept as whole"), F.expr("lang_n + 2 * kept as lang_whole"),
    ).withColumn("zero", F.expr(_share("0L", "whole")))


def _scatter(table: pa.Table) -> pa.Table:
    """Corrections (lang, low, high, value) of the pairs of groups that share terms of one index block.

    The block's postings are sorted by term: the term-major index. Each group
    takes its terms' rows of the index and scatters them, for the peers behind
    it, into one dense accumulator over peers. What it adds is the value of the
    shared term less what the zero baselines count for it.
    """
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    g, p, zero = (table.column(c).to_numpy() for c in ("g", "p", "zero"))
    order = np.lexsort((g, term))
    term, g, p, zero = term[order], g[order], p[order], zero[order]
    ends = np.searchsorted(term, term, side="right")
    behind = ends - np.arange(len(term)) - 1
    by_group = np.argsort(g, kind="stable")
    cuts = np.flatnonzero(np.diff(g[by_group], prepend=-1))
    total = np.zeros(int(g.max()) + 1, np.int64)
    low, high, value = [], [], []
    for a, b in zip(cuts, [*cuts[1:], len(g)]):
        mine = by_group[a:b]
        mine = mine[behind[mine] > 0]
        steps = np.flatnonzero(np.diff((np.cumsum(behind[mine]) - behind[mine]) // STEP, prepend=-1))
        for x, y in zip(steps, [*steps[1:], len(mine)]):
            rows = mine[x:y]
            lengths = behind[rows]
            before = np.cumsum(lengths) - lengths
            peers = np.repeat(rows + 1 - before, lengths) + np.arange(int(lengths.sum()))
            own, own_zero, other, other_zero = np.repeat(p[rows], lengths), zero[rows[0]], p[peers], zero[peers]
            add = _gap(own, other) - _gap(own, other_zero) - _gap(own_zero, other) + _gap(own_zero, other_zero)
            np.add.at(total, g[peers], add)
        met = np.flatnonzero(total)
        low.append(np.full(len(met), g[by_group[a]]))
        high.append(met)
        value.append(total[met])
        total[met] = 0
    found = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (low, high, value)]
    lang = pa.repeat(table.column("lang")[0], len(found[0]))
    return pa.table([lang, *found], ["lang", "low", "high", "value"])


def _baseline(batches):
    """The value of each pair if its groups shared no term: a dense sum over all peers for each group.

    A group's terms come as the distinct shares with the number of their terms.
    """
    for batch in batches:
        for row in batch.to_pylist():
            zeros, terms_of = np.array(row["zeros"], np.int64), np.array(row["peer_terms"], np.int64)
            p, many = np.array(row["shares"] or [], np.int64), np.array(row["many"] or [], np.int64)
            total = np.zeros(len(zeros), np.int64)
            width = max(1, STEP // len(zeros))
            for i in range(0, len(p), width):
                total += (_gap(p[i:i + width, None], zeros[None, :]) * many[i:i + width, None]).sum(axis=0)
            peers, g = np.arange(len(zeros)), row["g"]
            neither = (row["kept"] - row["n_terms"] - terms_of) * _gap(zeros, row["zero"])
            total += np.where(peers > g, neither, 0)
            other = peers != g
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(row["lang"]), int(other.sum())), pa.array(np.minimum(peers, g)[other]),
                 pa.array(np.maximum(peers, g)[other]), pa.array(total[other])], ["lang", "low", "high", "value"])


def divergences(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 10,
                top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): each source held against the others, and its most telling terms.

    Part pair has every other source of the language, part term the `top` terms
    that the source has more often than its language; both by falling value,
    ties by item. Shares are whole numbers of parts in 10^9 with two pseudo-counts
    per term, and a value is the sum of floor((p - q)^2 / (p + q)) over terms.

    NULL in any of the three columns counts as an empty string. Repeated rows
    count as often as they occur; other columns are not read. A source without
    a kept term still has its rows of part pair; an empty table gives none.

    Terms of a language are cut into blocks of some hundred thousand postings, so a
    source with a third of all texts is spread over as many tasks as its terms
    need. A task holds one number per source of a language, as the accumulator
    is dense, and the postings of a block.
    """
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    index = write_and_reread(term_index(plain, least_docs), "term-index")
    stats = write_and_reread(_group_stats(plain, index), "groups")
    shares = write_and_reread(
        index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("post"))
        .select("lang", "term", "lang_n", "post.source", "post.n")
        .join(stats, ["lang", "source"])
        .select("lang", "g", "term", "zero", F.expr(_share("n", "whole")).alias("p"),
                F.expr(_share("lang_n", "lang_whole")).alias("q")), "shares")

    many = shares.agg(F.expr(f"1 + count(*) div {BLOCK}").alias("blocks"))
    placed = shares.select("lang", "g", "term", "zero", "p", F.pmod(F.xxhash64("term"), many.scalar()).alias("block"))
    shared = placed.groupBy("lang", "block").applyInArrow(_scatter, "lang string, low long, high long, value long")

    peers = stats.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("g", "zero", "n_terms"))).alias("peer")).select(
        "lang", F.col("peer.zero").alias("zeros"), F.col("peer.n_terms").alias("peer_terms"))
    own = shares.groupBy("lang", "g", "p").agg(F.count("*").alias("many")).groupBy("lang", "g").agg(
        F.collect_list("p").alias("shares"), F.collect_list("many").alias("many"))
    alone = (
        stats.join(own, ["lang", "g"], "left").join(peers, "lang")
        .select("lang", F.col("g").cast("long").alias("g"), "kept", "n_terms", "zero", "shares", "many", "zeros", "peer_terms")
        .mapInArrow(_baseline, "lang string, low long, high long, value long"))
    pairs = shared.unionByName(alone).groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))
    names = stats.select("lang", "source", F.col("g").cast("long").alias("g"), "kept")
    both = pairs.select("lang", F.expr("inline(array(struct(low as g, high as h), struct(high as g, low as h)))"), "value")
    pair = both.join(names, ["lang", "g"]).join(
        names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.expr("if(kept = 0, 0L, value) as value"))
    ahead = shares.filter("p > q").select(
        "lang", "g", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q) as value"))

    def ranked(df, by):
        best = Window.partitionBy("lang", by).orderBy(F.desc("value"), "item")
        return df.withColumn("rank", F.row_number().over(best))

    term = ranked(ahead, "g").filter(F.col("rank") <= top).join(names.drop("kept"), ["lang", "g"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return ranked(pair, "source").unionByName(term)
