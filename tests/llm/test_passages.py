"""Fill-in-the-middle cuts, source divergence and repeated passages against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from llm_rows import CLASHING, SCHEMA, WORDS, prose
from tidemark.llm import divergence, fim, passages, queries


@pytest.mark.parametrize("name", ["op11_passages", "op12_divergence", "op13_fill_in_middle"])
def test_queries_against_sql(spark, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.SQL[name]) == []


# --- fill in the middle ---------------------------------------------------------------------------------

def test_wavelet_ranks():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        codes = rng.integers(0, 13, size).astype(np.uint8)
        matrix = fim.WaveletMatrix(codes)
        at = np.arange(size + 1)
        for code in range(16):
            assert (matrix.rank(code, at) == np.concatenate([[0], np.cumsum(codes == code)])).all()


def units(text, unit):
    """The text in units, what comes before the first one first."""
    if unit == "characters":
        return [""] + list(text)
    if unit == "lines":
        return [""] + re.findall(r"[^\n]*\n|[^\n]+", text)
    lead = re.match(r"[\x20\x09-\x0D]*", text).group()
    return [lead] + re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text[len(lead):])


def plain_fim(key, text, unit="characters", plain=10, spm=20):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    parts = units(text, unit)
    n = len(parts) - 1
    a, b = sorted(x % (n + 1) for x in h[:2])
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    # No unit has begun before the blanks of the first part end; without units a cut after 0 is the end of the text.
    p, m, s = "".join(parts[:a + 1]), "".join(parts[a + 1:b + 1]), "".join(parts[b + 1:])
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", list(fim.UNITS))
def test_fim_of_odd_texts(spark, odd_docs, odd_rows, unit):
    extra = [(200 + i, t, "en", "a") for i, t in enumerate(
        ["<P>", "a <S> b", "x<M", "<", "é" * 7, "\n\n a\n", " lead", "a\n", "日本\n語 x\x0b\U0001f600"])]
    extra += [(300 + i, "ab <S é\n" * 3, "en", "a") for i in range(40)]
    docs = odd_docs.unionByName(spark.createDataFrame(extra, SCHEMA).withColumns({c: F.lit("") for c in CLASHING}))
    out = fim.transform(docs, unit=unit)
    assert out.columns == [*odd_docs.columns, "fim"]
    found = out.withColumn("back", fim.restored(F.col("fim.output"), F.col("fim.form"))).collect()
    want = Counter((r[0], *plain_fim(r[0], r[1], unit)) for r in odd_rows + extra)
    assert Counter((r["doc_id"], *r["fim"]) for r in found) == want
    assert all(r["back"] == (r["text"] or "") for r in found)
    assert {r["fim"]["form"] for r in found} == {"plain", "psm", "spm"}


def test_fim_of_an_empty_table_and_of_one_with_that_column(spark, no_docs):
    assert fim.transform(no_docs).collect() == []
    row, = fim.transform(spark.createDataFrame([(1, "ab", 5)], "doc_id long, text string, fim int")).collect()
    assert row["fim"]["n"] == 2


def test_fim_of_slices_and_other_markers(spark):
    rnd = random.Random(3)
    texts = [prose(rnd, rnd.randrange(0, 4000)) + "é" for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = fim.transform(docs, markers=("[pre]", "[suf]", "[mid]"), plain_percent=0, spm_percent=50)
    back = out.select("text", fim.restored(F.col("fim.output"), F.col("fim.form"), ("[pre]", "[suf]", "[mid]")).alias("b"), "fim.form")
    got = back.collect()
    assert all(r["b"] == r["text"] for r in got) and {r["form"] for r in got} == {"psm", "spm"}
    import pyarrow as pa
    whole = pa.array(texts)
    numbers = pa.array(range(60), pa.int64())
    assert fim.cut_texts(whole, numbers, numbers, "words").slice(20).equals(
        fim.cut_texts(whole.slice(20), numbers.slice(20), numbers.slice(20), "words"))


# --- divergence of sources ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_divergence(rows, least=10, top=10):
    counts, seen, langs = defaultdict(Counter), Counter(), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = Counter(TERM.findall((text or "").translate(LOWER)))
        counts[lang or "", source or ""].update(found)
        seen.update((lang or "", t) for t in found)
    for (lang, _), found in counts.items():
        langs[lang].update({t: n for t, n in found.items() if seen[lang, t] >= least})
    out = []
    for (lang, source), own in counts.items():
        kept = list(langs[lang])

        def shares(found):
            whole = sum(found[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (found[t] + 2) // whole for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = shares(own), shares(langs[lang])
        pair = [(s, sum(gap(p[t], r[t]) for t in kept)) for (x, s), found in counts.items() if x == lang and s != source
                for r in [shares(found)]]
        term = [(t, gap(p[t], q[t])) for t in kept if own[t] and p[t] > q[t]]
        for part, items, most in (("pair", pair, None), ("term", term, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(items[:most])]
    return Counter(out)


def told(df):
    return Counter(tuple(r) for r in df.collect())


def test_divergence_of_odd_texts(spark, odd_docs, odd_rows):
    for least in (1, 3, 10):
        assert told(divergence.divergences(odd_docs, least_docs=least)) == plain_divergence(odd_rows, least)


def test_divergence_in_many_blocks_and_steps(spark, monkeypatch):
    rnd = random.Random(11)
    words = [a + b for a in WORDS for b in WORDS[:9]] + ["Éa", "É", "zz\u00a0y"]
    rows = [(i, " ".join(rnd.choices(words[:rnd.randrange(3, len(words))], k=rnd.randrange(0, 200))), rnd.choice("xy"),
             "hot" if i % 3 == 0 else f"s{rnd.randrange(30)}") for i in range(400)]
    rows += [(1000, None, "x", "silent"), (1001, "1 2 3", "z", "alone"), (1002, "", "z", None)]
    for name, value in (("BLOCK", 500), ("STEP", 50), ("HELD", 100)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert told(divergence.divergences(docs, least_docs=4)) == plain_divergence(rows, 4)


def test_divergence_of_an_empty_table(no_docs):
    assert divergence.divergences(no_docs).collect() == []


def test_scatter_and_baseline_steps():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    n, v = 7, 40
    counts = rng.integers(0, 4, (n, v)) * rng.integers(0, 2, (n, v))
    whole = counts.sum(axis=1) + 2 * v
    p = 1 + 10**9 * (counts + 2) // whole[:, None]
    zero = 1 + 10**9 * 2 // whole
    g, t = np.nonzero(counts)
    table = pa.table([pa.array(["x"] * len(g)), pa.array(g.astype(np.int32)), pa.array([str(i) for i in t]), pa.array(zero[g]), pa.array(p[g, t])],
                     ["lang", "g", "term", "zero", "p"])
    found = {(r["low"], r["high"]): r["value"] for r in divergence._scatter(table).to_pylist()}
    for a in range(n):
        for b in range(a + 1, n):
            both = (counts[a] > 0) & (counts[b] > 0)
            want = sum(divergence._gap(p[a, i], p[b, i]) - divergence._gap(p[a, i], zero[b]) - divergence._gap(zero[a], p[b, i])
                       + divergence._gap(zero[a], zero[b]) for i in np.flatnonzero(both))
            assert found.get((a, b), 0) == want


# --- repeated passages ----------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_cut(rows, length):
    """(key, text) -> (n_words, n_removed, kept); rows with one key must hold one text."""
    texts = {(r[0], tuple(WORD.findall(r[1] or ""))) for r in rows}
    seen, out = set(), {}
    for key, words in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        covered = set()
        for i in range(len(words) - length + 1):
            window = words[i:i + length]
            if window in seen:
                covered.update(range(i, i + length))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in covered]
        out[key, words] = (len(words), len(covered), " ".join(kept))
    return Counter((r[0], *out[r[0], tuple(WORD.findall(r[1] or ""))]) for r in rows)


def cut_of(docs, length=20):
    return Counter((r["doc_id"], *r["cut"]) for r in passages.cut_repeats(docs, length=length).select("doc_id", "cut").collect())


def test_difference_covers():
    for period, cover in passages.COVERS.items():
        for a in range(period):
            for b in range(period):
                assert any((a + d) % period in cover and (b + d) % period in cover for d in range(period))
    assert passages.cover_of(20) == (13, (0, 1, 3, 9), 8)
    for length in range(1, 200):
        period, _, width = passages.cover_of(length)
        assert period + width - 1 == length and width >= 1


def test_rolling_hashes():
    known = passages.WordHashes()
    words = passages.Words([b"a b a b a b c", b"", None, b"b a b", b"a"], known)
    found = words.windows(3, passages.MULTIPLIERS[0])
    text = b"a b a b a b c b a b a".split()
    seen = defaultdict(set)
    for i in range(len(text) - 2):
        seen[tuple(text[i:i + 3])].add(int(found[i]))
    assert all(len(x) == 1 for x in seen.values()) and len(set.union(*seen.values())) == len(seen)
    assert words.lengths.tolist() == [7, 0, 0, 3, 1] and words.place.tolist() == [0, 1, 2, 3, 4, 5, 6, 0, 1, 2, 0]


def test_word_hashes_are_forgotten(monkeypatch):
    monkeypatch.setattr(passages, "KNOWN_WORDS", 3)
    known = passages.WordHashes()
    first = [known[w] for w in (b"a", b"b", b"c", b"d", b"a")]
    assert first[0] == first[4] and len(set(first)) == 4 and len(known) <= 3


@pytest.mark.parametrize("length", [1, 2, 5, 20, 33])
def test_cuts_of_planted_passages(spark, length):
    rnd = random.Random(length)
    pool = [[rnd.choice(WORDS) for _ in range(rnd.randrange(length, 3 * length + 2))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rnd.randrange(0, 5)):
            words += [f"{rnd.choice(WORDS)}{rnd.randrange(9)}" for _ in range(rnd.randrange(0, 30))]
            piece = rnd.choice(pool)
            words += piece[rnd.randrange(0, 3):len(piece) - rnd.randrange(0, 3)] * rnd.randrange(1, 3)
        rows.append((rnd.randrange(10**6) * 200 + i, rnd.choice([" ", "\n", " \t"]).join(words), "en", "a"))
    rows += [(r[0] * 3 + 1, " ".join(r[1].split()), "fr", "b") for r in rows[:30]]
    rows += rows[5:9] + [(7, "x " * (3 * length + 5), "en", "a"), (8, "x " * length, "en", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain_cut(rows, length)
    assert sum(r[2] for r in want) > 100
    assert cut_of(docs, length) == want


def test_cuts_of_odd_texts(spark, odd_docs, odd_rows):
    out = passages.cut_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "cut"]
    assert out.select(*CLASHING).distinct().count() == 1
    assert Counter((r["doc_id"], *r["cut"]) for r in out.select("doc_id", "cut").collect()) == plain_cut(odd_rows, 20)


def test_texts_of_one_key(spark):
    """Several texts of one key: the one that is first by its hash keeps the words, the same at every run."""
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(5, f"{x} {passage} {x}", "en", "a") for x in "abc"] + [(None, passage, "en", "a")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    found = cut_of(docs.repartition(3))
    assert sorted(r[2] for r in found.elements()) == [0, 25, 25, 25, 25]
    assert found == cut_of(docs.coalesce(1))


def test_cuts_of_an_empty_table_and_text_keys(spark, no_docs):
    assert passages.cut_repeats(no_docs).collect() == []
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([("b", passage), ("a", passage + " end"), ("c", None)], "doc_id string, text string")
    assert cut_of(docs) == Counter([("a", 31, 0, passage + " end"), ("b", 30, 30, ""), ("c", 0, 0, "")])
