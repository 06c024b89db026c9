"""Quality, language, near-duplicates, mix and shards against plain Python."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
import zlib
from pyspark.sql import functions as F

from llm_rows import CLASHING, SCHEMA, WORDS, prose
from tidemark.llm import langid, mixing, quality, sharding, simhash
from tidemark.session import write_and_reread

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(inside))


def test_quality_counts(odd_docs, odd_rows):
    texts = [r[1] for r in odd_rows] + ["a b c d e a b c d e", "x x x x x x", "q\nq\n \nq", "a b c d", "a b c d e\n" * 3]
    for text in texts:
        assert quality.counts(text.encode() if text else None)[:5] == plain_counts(text)
    found = quality.judge(write_and_reread(
        quality.with_counts(odd_docs.select("doc_id", "lang", "source", "text")).drop("text"), "t"), least=30).collect()
    assert len(found) == len(odd_rows)
    want = Counter((r[0], *plain_counts(r[1])) for r in odd_rows)
    assert Counter((r["doc_id"], *r["counts"][:5]) for r in found) == want
    for r in found:
        n, repeat = r["counts"]["n_words"], r["counts"]["n_repeat_words"]
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert not (r["base_failed"] and r["kept"])


def test_quality_chi_square():
    # One and two degrees have closed forms; tables give the rest.
    assert quality.chi2_share(2.0, 2) == pytest.approx(1 - np.exp(-1))
    assert quality.chi2_limit(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    assert quality.chi2_limit(0.99, 6) == pytest.approx(16.8119, abs=1e-3)


def test_covariance_determinant_ignores_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([1.0, 2.0], [[0.04, 0.02], [0.02, 0.09]], 4000)
    bad = rng.multivariate_normal([4.0, 0.5], [[0.01, 0], [0, 0.01]], 600)
    rows = [("g", float(a), float(b)) for a, b in np.vstack([good, bad])] + [("one", 1.0, 1.0)]
    found = {r["grp"]: r for r in quality.covariance_determinant(
        write_and_reread(spark.createDataFrame(rows, "grp string, a double, b double"), "t"),
        ["a", "b"], (0.01, 0.01), steps=4).collect()}
    assert np.allclose(found["g"]["centre"], [1.0, 2.0], atol=0.03)
    scatter = np.linalg.inv(np.array(found["g"]["inverse"]).reshape(2, 2))
    assert np.allclose(scatter, [[0.04, 0.02], [0.02, 0.09]], rtol=0.5)  # outliers leave room in the share
    # The same concentration steps in numpy, on the same start.
    x = np.vstack([good, bad])
    centre = np.median(x, axis=0)
    inverse = np.diag(1 / ((1.4826 * np.median(abs(x - centre), axis=0)) ** 2 + 1e-4))
    scale = 0.75 / quality.chi2_share(quality.chi2_limit(0.75, 2), 4)
    for _ in range(4):
        far = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
        inside = x[far <= np.quantile(far, 0.75)]
        centre, cov = inside.mean(axis=0), np.cov(inside.T, bias=True) * scale + np.eye(2) * 1e-4
        inverse = np.linalg.inv(cov)
    assert np.allclose(found["g"]["centre"], centre, atol=0.01) and np.allclose(scatter, cov, rtol=0.1)
    assert found["one"]["size"] == 1


def test_quality_keeps_ordinary_documents(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, rnd.randrange(20, 400)), "en", "a") for i in range(400)]
    rows += [(1000 + i, " ".join(w + "###" for w in prose(rnd, 100).split()), "en", "a") for i in range(10)]
    rows += [(2000 + i, prose(rnd, 60), None, f"small {i}") for i in range(5)]
    kept = {r[0] for r in quality.keep_good(spark.createDataFrame(rows, SCHEMA)).select("doc_id").collect()}
    assert kept == {r[0] for r in rows if r[0] < 1000 or r[0] >= 2000}


def unlike(rnd, n, kind=None):
    """n words or so in lines of eight, clean or unlike other texts in one statistic."""
    words = [rnd.choice(WORDS) + rnd.choice(WORDS)[:2] + rnd.choice(WORDS) for _ in range(n)]
    if kind == "symbols":
        words[::10] = [w + "#" for w in words[::10]]
    if kind == "long words":
        words = [w * 2 for w in words]
    if kind == "repeats":  # somewhat under a fifth of the words
        for i in range(0, n - 31, 32):
            words[i:i + 6] = ["ka", "lofilden", "migosping", "nehumra", "tu", "sorafilhumt"]
    lines = [" ".join(words[i:i + 8]) for i in range(0, n, 8)]
    return ("\nyes\n" if kind == "lines" else "\n").join(lines)


def test_quality_each_statistic_rejects_alone(spark):
    rnd = random.Random(2)
    rows = [(i, unlike(rnd, rnd.randrange(40, 2000)), "en", "a") for i in range(300)]
    odd = [(kind, n) for kind in ("symbols", "lines", "repeats", "long words") for n in (300, 600, 3000)]
    rows += [(1000 + i, unlike(rnd, n, kind), "en", "a") for i, (kind, n) in enumerate(odd)]
    found = {r["doc_id"]: r for r in quality.judge(write_and_reread(quality.with_counts(
        spark.createDataFrame(rows, SCHEMA)).drop("text"), "t")).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert {i for i, r in found.items() if not r["kept"]} == {1000 + i for i in range(len(odd))}


def plain_rates(rows):
    """Characters, different words and marks per word of each language."""
    sums = defaultdict(lambda: np.zeros(4))
    for lang, _, c in rows:
        sums[lang] += [c["word_chars"], c["n_distinct"], c["n_marks"], c["n_words"]]
    return {lang: s[:3] / s[3] for lang, s in sums.items()}


def plain_statistics(c, rates):
    n, few = c["n_words"] + 50, c["n_words"] + 10
    return [np.log((c["word_chars"] + 50 * rates[0]) / n), np.sqrt(c["n_symbols"] / n), np.sqrt(c["n_dup_lines"] / (c["n_lines"] + 5)),
            np.sqrt(c["n_repeat_words"] / n), np.log((c["n_distinct"] + 10 * rates[1]) / few), np.sqrt((c["n_marks"] + 10 * rates[2]) / few)]


def plain_distances(rows, least, floors=quality.FLOORS, prior=quality.PRIOR, share=0.75, steps=3):
    """rows: (lang, source, counts) that pass the plain limits -> squared distances, by the steps that fit() documents."""
    rates = plain_rates(rows)
    x = np.array([plain_statistics(r[2], rates[r[0]]) for r in rows])
    p, floor = x.shape[1], np.diag(np.square(floors))

    def binned(values, share, bin_of, edge_of):
        bins = np.sort(np.floor(bin_of(values)))
        return edge_of(bins[max(int(np.ceil(share * len(bins))), 1) - 1])

    def middle(values):
        return np.array([binned(v, 0.5, lambda v: v * 1024, lambda b: (b + 0.5) / 1024) for v in values.T])

    def estimate(x):
        centre = middle(x)
        inverse = np.diag(1 / ((1.4826 * middle(abs(x - centre))) ** 2 + np.square(floors)))
        for _ in range(steps):
            far = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
            inside = x[far <= binned(far, share, lambda f: np.log(np.maximum(f, 1e-12)) * 50, lambda b: np.exp((b + 1) / 50))]
            centre = inside.mean(axis=0)
            scatter = np.cov(inside.T, bias=True) * share / quality.chi2_share(quality.chi2_limit(share, p), p + 2)
            inverse = np.linalg.inv(scatter + floor)
        return len(x), centre, scatter

    def drawn(own, above):
        n, c, s = own
        return n, (n * c + least * above[1]) / (n + least), (n * s + least * above[2]) / (n + least)

    n, c, s = estimate(x)
    whole = n, c, (n * s + least * np.diag(np.square(prior))) / (n + least)
    langs = {k: drawn(estimate(x[[r[0] == k for r in rows]]), whole) for k in {r[0] for r in rows}}
    out = np.zeros(len(rows))
    for k in {r[:2] for r in rows}:
        own = np.array([r[:2] == k for r in rows])
        _, c, s = drawn(estimate(x[own]), langs[k[0]])
        out[own] = np.einsum("ni,ij,nj->n", x[own] - c, np.linalg.inv(s + floor), x[own] - c)
    return out


@pytest.mark.parametrize("least", [10, 100])
def test_quality_verdicts_row_by_row(spark, odd_rows, least):
    rnd = random.Random(4)
    rows = odd_rows + [(100 + i, unlike(rnd, rnd.randrange(12, 600), rnd.choice([None] * 12 + ["symbols", "long words", "lines", "repeats"])),
                        rnd.choice(["en", "en", "fr", None]), rnd.choice(["a", "a", "b", None])) for i in range(300)]
    counted = write_and_reread(quality.with_counts(spark.createDataFrame(rows, SCHEMA).repartition(4)).drop("text"), "t")
    found = quality.judge(counted, least=least).collect()
    assert len(found) == len(rows)
    passed = [r for r in found if not r["base_failed"]]
    want = plain_distances([(r["lang"], r["source"], r["counts"]) for r in passed], least)
    limit = quality.chi2_limit(1 - 1e-6, 6)
    assert np.allclose([r["distance"] for r in passed], want, rtol=1e-6)
    assert [r["kept"] for r in passed] == (want <= limit).tolist()
    assert not any(r["kept"] for r in found if r["base_failed"]) and 5 < sum(want > limit) < len(want) / 2


def test_quality_finds_what_no_single_limit_finds(spark):
    """Long words and few marks together are unlike the rest; each alone is nearer to the centre than in rows that stay."""
    rng = np.random.default_rng(5)
    def row(key, u, off=0.0):
        return (key, "en", "a", (1000, int(5000 + 500 * u), 0, 0, 0, 50, 700, int(120 * (1 + 0.25 * u + off))))
    rows = [row(i, rng.normal()) for i in range(500)] + [row(900 + i, s * 2.2) for i, s in enumerate((-1, 1))]
    rows += [row(1000, 1.8, -0.25 * 3.6), row(1001, -1.8, 0.25 * 3.6)]
    counted = write_and_reread(spark.createDataFrame(
        rows, "doc_id long, lang string, source string, counts struct<" + ",".join(f"{c}:long" for c in quality.COUNTS) + ">"), "t")
    found = {r["doc_id"]: r for r in quality.judge(counted).collect()}
    assert {i for i, r in found.items() if not r["kept"]} == {1000, 1001}
    rates = plain_rates([("en", "a", r["counts"]) for r in found.values()])["en"]
    stats = {i: np.array(plain_statistics(r["counts"], rates)) for i, r in found.items()}
    centre = np.median(list(stats.values()), axis=0)
    for odd in (1000, 1001):  # a row that stays is farther out in every statistic, so no weights of the squares part the two
        off = abs(stats[odd] - centre)
        assert any((off <= abs(stats[stays] - centre) + 1e-12).all() for stays in (900, 901))


def test_stages_keep_columns(odd_docs):
    for stage in (lambda d: quality.keep_good(d, least=30), langid.keep_identified, simhash.keep_first, mixing.training_order):
        out = stage(odd_docs)
        assert out.columns == odd_docs.columns
        assert out.select(*CLASHING).distinct().count() == 1


def test_stages_on_empty_tables(no_docs):
    for stage in (quality.keep_good, langid.keep_identified, simhash.keep_first, mixing.training_order,
                  langid.identify, mixing.mixed, sharding.shard):
        assert stage(no_docs).count() == 0


def plain_grams(text, orders):
    letters = [c.lower()[0] if c.isalpha() else " " for c in text]
    flat = " " + re.sub(" +", " ", "".join(letters)).strip(" ") + " "
    return sum(max(0, len(flat) - n + 1) for n in orders)


def test_language(spark, odd_docs, odd_rows):
    for text in ("Ab c", "É\n\n-ß", "aaaa bb", "x" * 3000):
        assert langid.gram_counts(text).sum() == plain_grams(text, langid.ORDERS)
    assert langid.gram_counts("12 #\n") is None
    whole = langid.gram_counts("ab cd " * 500)
    old, langid.PIECE = langid.PIECE, 100
    assert (langid.gram_counts("ab cd " * 500) == whole).all()
    langid.PIECE = old

    rnd = random.Random(2)
    speak = {"en": "the of and ing tion", "fr": "le que eau oi ment", "de": "der sch ung keit pf"}
    rows = [(i, " ".join(rnd.choice(speak[lang].split()) for _ in range(rnd.randrange(5, 40))), lang, "s")
            for i in range(400) for lang in [rnd.choice(sorted(speak))]]
    found = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    tested = [r for r in found if r["held_out"]]
    assert len(tested) > 50 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in tested]) > 0.95

    found = langid.identify(odd_docs).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    unknown = Counter(r[0] for r in odd_rows if not re.search(r"[^\W\d_]", r[1] or ""))
    assert Counter(r["doc_id"] for r in found if r["lang_pred"] == "und") == unknown


def test_language_ignores_held_out_labels(spark):
    rows = [(i, "alpha beta gamma", "en", "s") for i in range(40)]
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    found = langid.identify(spark.createDataFrame(wrong, SCHEMA)).collect()
    assert {r["lang_pred"] for r in found} == {"en"}


def plain_bayes(rows, bits=langid.BITS, smoothing=0.5):
    """(lang_pred, score) per text by counting n-grams one by one."""
    def grams(text):
        flat = " " + re.sub(" +", " ", "".join(c.lower()[0] if c.isalpha() else " " for c in text)) + " "
        found = Counter()
        for i in range(len(flat)):
            code = 0
            for c in flat[i:i + 3]:
                code = (code * int(langid.STEP) + ord(c) + 1) % 2**32
                found[code * int(langid.SPREAD) % 2**32 >> 32 - bits] += 1
        return found if flat.strip() else None

    taught = {}
    for key, text, lang, _ in rows:
        if text and lang is not None and zlib.crc32(str(key).encode()) % 4 != 2:
            taught.setdefault(lang, Counter()).update(grams(text) or {})
    size = {k: sum(c.values()) + smoothing * 2**bits for k, c in taught.items()}
    out = []
    for _, text, _, _ in rows:
        found = grams(text) if text else None
        if found is None or not taught:
            out.append(("und", 0.0))
            continue
        score = {k: sum(n * np.log((c[g] + smoothing) / size[k]) for g, n in found.items()) for k, c in taught.items()}
        best = min(score, key=lambda k: (-round(score[k], 9), k))
        out.append((best, float(1 / sum(np.exp(s - score[best]) for s in score.values()))))
    return out


@pytest.mark.parametrize("block", [1, 2, 256])
def test_language_is_plain_naive_bayes(spark, odd_rows, block):
    rnd = random.Random(9)
    speak = {"en": "the of and ing", "fr": "le que eau oi é", "de": "der sch ung ß", "zz": "the le der"}
    rows = [(1000 + i, " ".join(rnd.choice(speak[lang].split()) for _ in range(rnd.randrange(1, 9))), lang, "s")
            for i in range(120) for lang in [rnd.choice(sorted(speak))]]
    rows += [(i, t, lang, s) for i, t, lang, s in odd_rows if i is not None and len(t or "") < 2000]
    want = Counter((r[0], w[0], round(w[1], 6)) for r, w in zip(rows, plain_bayes(rows)))
    found = langid.identify(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()
    assert Counter((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in found) == want


def test_many_languages_and_none(spark):
    rnd = random.Random(3)
    own = {f"l{i:03}": [rnd.choice(WORDS) + rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(4)] for i in range(600)}
    rows = [(i * 10 + j, " ".join(rnd.choices(words, k=30)), lang, "s") for i, (lang, words) in enumerate(own.items()) for j in range(4)]
    found = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    taught = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    right = [truth[r["doc_id"]] == r["lang_pred"] for r in found if truth[r["doc_id"]] in taught]
    assert len(taught) > 590 and np.mean(right) > 0.97

    bare = spark.createDataFrame([(1, "some text", None, "s"), (2, "12 34", None, "s"), (3, None, None, "s"), (4, "é", None, None)], SCHEMA)
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(bare).collect()} == {(i, "und", 0.0) for i in range(1, 5)}
    assert {r["doc_id"] for r in langid.keep_identified(bare).collect()} == {1, 4}


def plain_print(text, k=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    """prints: [(key, fingerprint)] -> smallest key reachable per row."""
    nodes = sorted({p for _, p in prints})
    parent = {p: p for p in nodes}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(nodes, 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, p in prints:
        least[root(p)].append(k)
    return [min((k for k in least[root(p)] if k is not None), default=None) for _, p in prints]


def test_simhash(odd_docs, odd_rows):
    prints = write_and_reread(simhash.with_fingerprint(odd_docs.select("doc_id", "text")).drop("text"), "t")
    groups = simhash.near_duplicates(prints)
    found = Counter((r[0], r[1] & (1 << 64) - 1, r[2]) for r in prints.join(groups, "fingerprint").select(
        "doc_id", "fingerprint", "component_id").collect())
    plain = [(r[0], plain_print(r[1])) for r in odd_rows]
    assert found == Counter((k, p, c) for (k, p), c in zip(plain, plain_components(plain)))
    kept = simhash.keep_first(odd_docs).select("doc_id", "text").collect()
    assert len({plain_print(r["text"]) for r in kept}) == len(kept) == len(
        {c if c is not None else ("none", p) for (_, p), c in zip(plain, plain_components(plain))})


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_find_all_pairs(spark, distance):
    rnd = random.Random(distance)
    prints = set()
    for _ in range(25):
        base = rnd.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            flips = rnd.sample(range(64), rnd.randrange(1, 7))
            prints.add(base ^ sum(1 << f for f in flips))
    prints |= {0, 1, 1 << 63, (1 << 64) - 1, 3, 1 | 1 << 63}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), distance).collect()
    want = {(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_components_of_a_long_chain(spark):
    rnd = random.Random(5)
    nodes = rnd.sample(range(-1000, 1000), 120)
    edges = [(min(a, b), max(a, b)) for a, b in zip(nodes[:100], nodes[1:100])] + [(min(nodes[100:102]), max(nodes[100:102]))]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{n: min(nodes[:100]) for n in nodes[:100]}, **{n: min(nodes[100:102]) for n in nodes[100:102]}}


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(sizes.values())
    while True:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return {**target, **{s: weight[s] * level for s in open_}}
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
        rest -= sum(most * sizes[s] for s in over)


def test_mixing(odd_docs, odd_rows):
    found = mixing.mixed(odd_docs, rows_per_bucket=7).collect()
    assert len(found) == len(odd_rows)
    size = lambda r: len(WORD.findall(r[1] or ""))
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((r[0], size(r)) for r in odd_rows)
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += size(r)
    want, taken, largest = plain_targets(sizes), Counter(), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    places = [r["first_position"] for r in found if r["first_position"] is not None]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)
    again = mixing.mixed(odd_docs.repartition(5), rows_per_bucket=7).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in found)
    rows = mixing.training_order(odd_docs, rows_per_bucket=7)
    assert Counter(r[0] for r in rows.select("doc_id").collect()) == sum(
        (Counter({r["doc_id"]: r["copies"]}) for r in found), Counter())


def test_targets_with_many_limits(spark):
    rnd = random.Random(4)
    for case in range(3):
        sizes = {rnd.choice("abcdefgh") + str(i): rnd.choice([0, 1, 10, 1000, 50_000]) for i in range(17)} | {None: 5, "": 7, "é": 100}
        found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = plain_targets(sizes)
        assert {r["source"]: pytest.approx(r["target"]) for r in found} == want


def test_position_inverts_demand(spark):
    rows = [(d / 20, s) for d in range(21) for s in mixing.SHAPES]
    found = spark.createDataFrame(rows, "d double, s double").select(
        "d", "s", mixing.position(F.col("d"), F.col("s")).alias("t")).collect()
    for r in found:
        assert r["s"] * r["t"] + (1 - r["s"]) * r["t"] ** 2 == pytest.approx(r["d"])


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 3), (3, 2), (4, 2)])
def test_hilbert_curve(dimensions, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dimensions)))
    place = sharding.hilbert_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def shards_read(rows, shard_of):
    """Mean shards whose least and greatest value leave room for a value: per language, per source, and for nine sizes."""
    spans = defaultdict(list)
    for r in rows:
        spans[shard_of(r)].append(r)
    edges = [[(min(c), max(c)) for c in zip(*((r["lang"], r["source"], r["size"]) for r in own))] for own in spans.values()]
    sizes = sorted(r["size"] for r in rows)
    wanted = [sorted({r["lang"] for r in rows}), sorted({r["source"] for r in rows}), [sizes[len(sizes) * i // 10] for i in range(1, 10)]]
    return [np.mean([sum(e[d][0] <= v <= e[d][1] for e in edges) for v in wanted[d]]) for d in range(3)]


def test_shards_are_pruned(spark):
    rnd = random.Random(12)
    rows = [(i, "x" * int(rnd.lognormvariate(6, 1.2)), rnd.choice(["de", "en", "en", "en", "es", "fr"]),
             rnd.choice(["hot"] * 10 + [f"s{j:02}" for j in range(20)])) for i in range(6000)]
    found = {r["doc_id"]: r for r in sharding.shard(spark.createDataFrame(rows, SCHEMA).repartition(4), 16).collect()}
    table = [{"lang": r[2], "source": r[3], **found[r[0]].asDict()} for r in rows]
    by_curve = shards_read(table, lambda r: r["shard"])
    by_hash = shards_read(table, lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 16)
    by_key = shards_read(table, lambda r: r["doc_id"] * 16 // 6000)
    assert min(by_hash) > 15 and min(by_key) > 15
    assert by_curve[0] < 11 and by_curve[1] < 8 and by_curve[2] < 12


def test_sharding(odd_docs, odd_rows):
    found = sharding.shard(odd_docs, 16).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    line = [r["hilbert"] for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
    assert line == sorted(line)
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by.values())
    again = sharding.shard(odd_docs.repartition(7), 16).collect()
    same = lambda rows: Counter((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in rows)
    assert same(again) == same(found)
    few = sharding.shard(odd_docs.limit(3), 16).collect()
    assert len(few) == 3 and all(r["slot"] == 0 for r in few)
    sums = sharding.manifest(sharding.shard(odd_docs), ["size", "hilbert"]).collect()
    assert sum(r["rows"] for r in sums) == len(odd_rows)
