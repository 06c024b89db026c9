"""Encoding, token files, licences, addresses and neighbours against plain Python, the library and SQL."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry_point
from compare import connect, differences
from llm_rows import CLASHING, SCHEMA, prose
from tidemark.llm import ann, bpe, licenses, queries, quality, rangecoder, simhash, tokenfile, urls

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ODD_TEXTS = [
    "", "   ", "Hello, it's <|endoftext|> \u2167\u00b2 \u03a3\u03c2\u03c3 \u0391\u03a3", "a<|endoftext|><|startoftext|>b <|ENDOFTEXT|> <|x|>",
    "\u0130stanbul\u00a0x\u2003y\x1cz\u0085q\u200b\u2028r", "e\u0301 \u0301 'S 'LL don't''s", "aaaaaaa aaaa aaaaaaaaaaa", "\U0001f600\U0001f468\u200d\U0001f469",
    "\ufb01 \u1e9e \u00df", "\ud55c\uad6d\uc5b4 \u65e5\u672c", "a,b.c--d...e 12345 x1y2", "\u209f\u208f \u0378",
]


def test_encoder_like_the_library(library):
    rnd = random.Random(1)
    spans = [(32, 127), (160, 0x500), (0x2000, 0x3100), (0xAC00, 0xAE00), (0x1F300, 0x1F700)]
    texts = ODD_TEXTS + ["".join(chr(rnd.randrange(*rnd.choice(spans))) for _ in range(60)) for _ in range(300)]
    for coder in (bpe.Encoder(bpe.read_vocabulary(PATH)), tokenfile.LibraryEncoder(bpe.read_vocabulary(PATH))):
        ids, n = coder.encode_batch([t.encode() for t in texts])
        runs = np.split(ids, np.cumsum(n)[:-1])
        for t, run in zip(texts, runs):
            want = library.encode(t, add_special_tokens=False).ids
            assert run.tolist() == want, t
            if isinstance(coder, bpe.Encoder) and not isinstance(coder, tokenfile.LibraryEncoder):
                assert coder.decode(want).decode() == library.decode(want, skip_special_tokens=False)
        again = coder.encode_batch([None, *[t.encode() for t in texts]])
        assert again[0].tolist() == ids.tolist() and again[1][0] == 0


def test_op5(odd_docs, odd_rows, library, no_docs):
    found = bpe.digests(odd_docs, PATH, with_ids=True).collect()
    want = Counter()
    for r in odd_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:4] for r in found) == want and all(len(r["ids"]) == r["n_tokens"] for r in found)
    encoded = bpe.decode(bpe.encode(odd_docs, PATH, keep=("doc_id", "size")), PATH)
    assert encoded.columns == ["doc_id", "size", "ids", "decoded"] and encoded.count() == len(odd_rows)
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in encoded.collect())
    assert bpe.digests(no_docs, PATH).count() == 0


@pytest.mark.parametrize("alphabet", [1, 2, 255, 257, 49_408])
def test_range_coder_round_trip(alphabet):
    rng = np.random.default_rng(alphabet)
    skewed = (rng.pareto(0.6, 5000) % alphabet).astype(np.int64)
    blocks = [rng.integers(0, alphabet, 700), np.empty(0, np.int64), np.zeros(4000, np.int64), skewed,
              np.tile(rng.integers(0, alphabet, 37), 50), np.array([alphabet - 1])]
    blocks += [rng.integers(0, alphabet, rng.integers(1, 40)) for _ in range(rangecoder.LANES + 5)]
    coded = rangecoder.encode_blocks(blocks, alphabet)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, rangecoder.decode_blocks(coded)))
    # A block alone gives the same bytes and reads back alone.
    assert rangecoder.encode_blocks([blocks[3]], alphabet) == [coded[3]]
    assert np.array_equal(rangecoder.decode_blocks([coded[4]])[0], blocks[4])


def test_range_coder_finds_damage_and_packs():
    rng = np.random.default_rng(0)
    ids = np.tile(rng.integers(0, 49_408, 400), 40)[:16_000]
    coded, = rangecoder.encode_blocks([ids], 49_408)
    assert len(coded) < 0.2 * 2 * len(ids)
    for at in (8, 13, 40, len(coded) // 2):
        broken = bytearray(coded)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            rangecoder.decode_blocks([bytes(broken)])
    with pytest.raises(ValueError):
        rangecoder.decode_blocks([b"no block"])
    with pytest.raises(ValueError):
        rangecoder.encode_blocks([np.zeros(rangecoder.LONGEST + 1, np.int64)], 5)


def test_range_coder_learns_an_uneven_alphabet():
    """Ids that follow no order are coded near the entropy of their counts: lanes of a block learn them together."""
    rng = np.random.default_rng(3)
    ids = rng.permutation(49_408)[np.minimum(rng.zipf(1.3, 2 * rangecoder.LONGEST), 2000) - 1]
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    blocks = [ids[:rangecoder.LONGEST], ids[rangecoder.LONGEST:]]
    coded = rangecoder.encode_blocks(blocks, 49_408)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, rangecoder.decode_blocks(coded)))
    assert 8 * sum(map(len, coded)) / len(ids) < 1.2 * -(share * np.log2(share)).sum()
    # More ids than order 0 has room for.
    many = rng.integers(0, 49_408, rangecoder.LONGEST)
    assert np.array_equal(rangecoder.decode_blocks(rangecoder.encode_blocks([many], 49_408))[0], many)


def test_library_sees_a_piece_once(monkeypatch):
    coder, seen = tokenfile.LibraryEncoder(bpe.read_vocabulary(PATH)), []
    call = coder.merges.call
    monkeypatch.setattr(coder.merges, "call", lambda pieces: seen.extend(pieces) or call(pieces))
    coder.encode_batch([b"Word, word. WORD (x1) isn't", b"word, X", None, "isn't \u00c9t\u00e9, \u00e9t\u00e9".encode()])
    coder.encode_batch([b"words: word", b"isn't"])
    assert len(seen) == len(set(seen)) + 1  # the comma once more, in a word with odd characters
    assert {"word", ",", ".", "(", "x", "1", ")", "isn", "'t", "\u00e9t\u00e9", "words", ":"} == set(seen)


def test_library_encoder_on_each_character(library):
    """Every character below U+0530, which a plain pattern cuts, and some of the others, between letters, alone and before a mark."""
    rnd = random.Random(2)
    some = [chr(c) for c in [*range(0x530), 0x1C89, 0xA7CB, 0x10D50,
                             *rnd.sample([c for c in range(0x530, 0x110000) if not 0xD800 <= c < 0xE000], 3000)]]
    texts = [f"A{c}b 'S{c} {c}{c}1 {c}\u0301x" for c in some]
    ids, n = tokenfile.LibraryEncoder(bpe.read_vocabulary(PATH)).encode_batch([t.encode() for t in texts])
    for t, run in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert run.tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t)


def test_last_blocks_are_halves():
    cutter = tokenfile.Cutter()
    sizes = np.array([5, tokenfile.BLOCK + 90, 0, tokenfile.BLOCK])
    ids = np.arange(int(sizes.sum()), dtype=np.int32)
    cutter.add(["a", "b", "c", "d"], ids, sizes)
    blocks = cutter.take(1) + cutter.take()
    assert [len(b[2]) for b in blocks] == [tokenfile.BLOCK, (tokenfile.BLOCK + 95) // 2, (tokenfile.BLOCK + 96) // 2]
    assert np.array_equal(np.concatenate([b[2] for b in blocks]), ids) and [b[0] for b in blocks] == [0, 1, 2]
    held = Counter()
    for _, _, part, pieces in blocks:
        assert sum(p[2] for p in pieces) == len(part)
        for o, k, n in pieces:
            held[o, k] += n
    assert [held[o, k] for o, k in enumerate("abcd")] == sizes.tolist() and not cutter.held and cutter.take() == []


def test_joined_checksum():
    rng = np.random.default_rng(0)
    parts = [rng.bytes(int(n)) for n in (5, 0, 1, 70_000, 13)]
    assert tokenfile.joined_crc(map(zlib.crc32, parts), map(len, parts)) == zlib.crc32(b"".join(parts))


def test_joined_checksums_of_many_runs():
    rng = np.random.default_rng(1)
    runs = [[rng.bytes(int(n)) for n in rng.choice([0, 1, 4, 7, 8192, 70_000], rng.integers(1, 9))] for _ in range(60)]
    flat = [p for run in runs for p in run]
    found = tokenfile.joined_crcs(np.array([zlib.crc32(p) for p in flat]), np.array([len(p) for p in flat]), np.array([len(r) for r in runs]))
    assert found.tolist() == [zlib.crc32(b"".join(run)) for run in runs]
    assert tokenfile.joined_crcs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def test_op4(spark, odd_docs, odd_rows, library, no_docs, tmp_path):
    path = tokenfile.write(odd_docs, PATH, 2, f"file://{tmp_path}/tokens")
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in tokenfile.summary(spark, path).orderBy("start").collect()]
    assert found == want
    pieces = tokenfile.read(spark, path).orderBy("part", "ordinal", "block").collect()
    assert max(Counter((p["part"], p["ordinal"]) for p in pieces).values()) > 1  # a text longer than a block
    flat = [i for p in pieces for i in p["ids"]]
    assert flat == [i for r in rows for i in library.encode(r[1] or "", add_special_tokens=False).ids + [2]]
    assert tokenfile.summary(spark, tokenfile.write(no_docs, PATH, 2)).count() == 0


def plain_licenses(text, threshold=0.8):
    out = []
    for i, line in enumerate((text or "").split("\n")):
        words = [w for w in re.split(r"[\W_]+", line.lower()) if w]
        pairs = set(zip(words, words[1:]))
        best = None
        for name, template in sorted(licenses.TEMPLATES.items()):
            want = licenses.template_words(template)
            other = set(zip(want, want[1:]))
            dice = 2 * len(pairs & other) / (len(pairs) + len(other)) if pairs else 0
            if dice >= threshold and (best is None or dice > best[1]):
                best = (name, dice)
        if best:
            out.append((i, *best, len(pairs)))
    return out


def test_op8(spark, odd_docs, odd_rows, no_docs):
    texts = [
        "All rights reserved.", "ALL   RIGHTS reserved!!", "all rights", "reserved", "x\nLicensed under the Apache License, Version 2.0\ny",
        "Licensed under the Apache License Version 2", "Licensed under the MIT License", "Released under the MIT License. " * 3,
        "This work is licensed under a GNU General Public License, version 3.", None, "", "\n\n", "word " * 5000 + "\nAll rights reserved."]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + odd_rows
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in (*CLASHING, "line", "license")})
    want = Counter((r[0], *m) for r in rows for m in plain_licenses(r[1]))
    assert Counter(map(tuple, licenses.scan(docs).collect())) == want and len(want) >= 6
    assert licenses.scan(no_docs).count() == 0 and licenses.scan(docs, {"none": "one"}).count() == 0
    # The size bounds leave out nothing that a lower threshold would find.
    low = Counter((r[0], *m) for r in rows for m in plain_licenses(r[1], 0.4))
    assert Counter(map(tuple, licenses.scan(docs, threshold=0.4).collect())) == low


def plain_passages(text, templates, told, threshold=0.8):
    """Windows of whole texts by trying each start with each template, without those that the lines told have."""
    placed = [(w, i) for i, line in enumerate((text or "").split("\n")) for w in re.split(r"[\W_]+", line.lower()) if w]
    words, found, chosen = [p[0] for p in placed], [], []
    for place, (name, template) in enumerate(sorted(templates)):
        want = licenses.template_words(template)
        other = set(zip(want, want[1:]))
        for at in range(max(len(words) - len(want), 0) + 1):
            run = words[at:at + len(want)]
            pairs = set(zip(run, run[1:]))
            shared = len(pairs & other)
            if pairs and 2 * shared / (len(pairs) + len(other)) >= threshold:
                found.append((-shared, -2 * shared / (len(pairs) + len(other)), place, at, at + len(run) - 1, name, len(pairs)))
    for w in sorted(found):
        if all(w[4] < c[3] or c[4] < w[3] for c in chosen):
            chosen.append(w)
    grams = dict((n, set(licenses.template_bigrams(t))) for n, t in licenses.TEMPLATES.items())
    lines = [set(licenses.template_bigrams(x)) for x in (text or "").split("\n")]
    return [(placed[a][1], name, -dice, n) for shared, dice, _, a, b, name, n in chosen
            if not any(m[1] == name and placed[a][1] <= m[0] <= placed[b][1] and len(grams[name] & lines[m[0]]) >= -shared for m in told)]


def test_op8_whole_texts(spark):
    """Notices that are wrapped, share a line with other words, or are headers and bodies of many lines."""
    rnd = random.Random(5)
    every = [*licenses.TEMPLATES.items(), *licenses.PASSAGES]

    def wrapped(text, width):
        words = text.split(" ")
        return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))

    texts = ["Licensed under the Apache License,\nVersion 2.0.", "Copyright 2020 Foo. All rights reserved.", "x All rights\nreserved. All\n\nrights reserved y",
             "# Licensed under the\n# Apache License Version 2", "Licensed under CC BY-SA 4.0", "All rights reserved. " * 30, "software license warranty " * 200]
    for name, template in every:
        texts += [template, wrapped(template, 3), f"{prose(rnd, 30)} {template} {prose(rnd, 30)}", f"{prose(rnd, 9)}\n{wrapped(template, 9)}\n{prose(rnd, 9)}",
                  f"{wrapped(template, 5)} {rnd.choice(every)[1]}", " ".join(w for w in template.split(" ") if rnd.random() > 0.05)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    found = Counter(map(tuple, licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()))
    want = Counter()
    for i, text, *_ in rows:
        told = plain_licenses(text)
        want.update((i, *m) for m in told + plain_passages(text, every, told))
    assert found == want
    names = {(i, name) for i, _, name, *_ in found}
    assert {(0, "Apache-2.0"), (1, "all-rights-reserved"), (2, "all-rights-reserved"), (3, "Apache-2.0"), (4, "CC-BY-SA-4.0")} <= names
    assert (0, 0, "Apache-2.0", 1.0, 7) in found and sum(n for k, n in found.items() if k[0] == 2) == 2
    for i, (name, _) in enumerate(every):  # as it is, wrapped, in a line with others, and as a passage between others
        assert all((7 + 6 * i + form, name) in names for form in range(4)), name


URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.ORG", "http://example.org/", "http://example.org/es/a", "http://a.b.example.org/en/12?x#y",
    "http://badexample.org/es/a", "http://x.com/fr/1", "http://x.com/de/1#top", "http://com/de/", "http://x.com?/de/", "a://b://c/d",
    "http://x.net/p?utm_source=q&b=2&a=1", "https://www.x.net/p/?a=1&b=2#f", "http://x.net/q", "http://\u00dc.net/\n/q", "http://x.net:80/q",
]


def test_op10(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 2 + ["http://hot.net/same"] * 200)] + [(None, "http://x.net/q"), (3, "http://x.net/q")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "block", "canonical")})
    listed = spark.createDataFrame([("x.net/q",), ("x.net/p?a=1&b=2",), ("hot.net/same",), (None,), ("nowhere.net/",), ("x.net/q",)], "canonical string")
    found = urls.judge(pages, listed).collect()

    def plain(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        best = None
        for h, p, v in urls.RULES:
            if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
                best = (h + p, v)
        return host, path, best
    assert len(found) == len(rows)
    want = Counter()
    on_list = {"http://x.net/q", "http://x.net/p?utm_source=q&b=2&a=1", "https://www.x.net/p/?a=1&b=2#f", "http://hot.net/same"}
    for i, u in rows:
        host, path, best = plain(u)
        want[i, host, path, best and best[0], best[1] if best else "block" if u in on_list else "allow"] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    allowed = urls.keep_allowed(pages, listed)
    assert allowed.columns == pages.columns and allowed.count() == sum(n for k, n in want.items() if k[4] == "allow")
    none = pages.limit(0)
    assert urls.judge(none, listed).count() == 0 and urls.judge(pages, listed.limit(0)).filter("verdict = 'block' and rule is null").count() == 0


def test_bloom_filter_misses_none_and_passes_few(spark):
    listed = spark.range(3000).select(F.concat(F.lit("in/"), "id").alias("u"))
    others = spark.range(20_000).select(F.concat(F.lit("out/"), "id").alias("u"))
    blocks = 3000 * urls.KEY_BITS // 256
    masks = [m.alias(f"m{i}") for i, m in enumerate(urls._masks(F.col("u")))]
    hit = " and ".join(f"word{i} & m{i} = m{i}" for i in range(urls.WORDS))
    passed = lambda rows: rows.select("u", urls._block(F.col("u"), blocks).alias("block"), *masks).join(
        urls.bloom_filter(listed, "u", blocks), "block").filter(hit).count()
    assert passed(listed) == 3000 and passed(others) < 0.02 * 20_000
    assert urls.on_list(listed.unionAll(others), listed, "u").count() == 3000


def plain_nearest(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids, vectors = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    out = {}
    for i, v in good:
        if i % 20 == 0:
            score = (vectors * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_op9(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)]  # one vector many times: ties go to smaller ids
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8), (2080, [float("inf")] + [1.0] * 7),
             (2100, [1.0] * 3), (None, [1.0] * 8), (2120, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("block", "id", "score", "lot", "rank")})
    want = plain_nearest(rows)
    ask = lambda key: key % 20 == 0
    # With the radius at the code length every code is retrieved, so the result is exact.
    found = ann.nearest(vectors, ask, radius=8, rows_per_block=100, queries_per_lot=6).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by == want and {r["rank"] for r in found} == set(range(1, 21))
    narrow = ann.nearest(vectors, ask, radius=0, rows_per_block=100)
    assert Counter(r["query_id"] for r in narrow.collect()) == Counter({q: 20 for q in want})
    assert ann.nearest(vectors.limit(0), ask).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(few, ask).collect()] == [(0, 1, 1, 3.0)]


def test_op9_repeated_keys(spark):
    """A key of several vectors is asked with the smallest in all blocks, and none of its rows is a candidate."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(20 * i, rng.normal(size=8).tolist()) for i in range(15) for _ in range(2)]
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    want = {}
    for one in range(0, 300, 20):
        score = (vectors * min(v for i, v in rows if i == one)).sum(axis=1)
        want[one] = [(int(ids[j]), float(score[j])) for j in np.lexsort((ids, -score)) if ids[j] != one][:20]
    for parts in (1, 5):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        found = {}
        for r in ann.nearest(table, lambda key: key % 20 == 0, radius=8, rows_per_block=100, queries_per_lot=6).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert found == want


def test_op9_probes_reach_the_whole_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (2000, 8))
    block = ann.Block(codes, 8)
    for radius in (0, 5, 16, 28):
        want = np.flatnonzero(np.bitwise_count(codes ^ codes[7]).sum(axis=1) <= radius)
        assert np.array_equal(block.within(codes[7], radius), want)


def test_op9_recall(spark, folder):
    table = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in ann.nearest(table, lambda key: key % 20 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        hits.append(len(found[ids[i]] & set(ids[np.argsort(-score)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_with_sql(spark, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.SQL[name]) == []


def test_registered():
    names = {f"op{n}_" for n in range(1, 11)}
    assert {n for n in names for q in entry_point.queries() if q.startswith(n)} == names
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def plain_copies(rows, most=3):
    """rows: (doc_id, source, size, hash) -> copies of each document in the mix, source by source, a limit at a time."""
    size = Counter()
    for _, source, n, _ in rows:
        size[source] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * size[s]}
        for s in over or free:
            target[s] = most * size[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    out = Counter()
    for s in names:
        start = 0
        for key, _, n, _ in sorted((r for r in rows if r[1] == s), key=lambda r: (r[3], r[0])):
            if n:
                out[key] = sum(p * size[s] + start + n / 2 < target[s] for p in range(most + 1))
            start += n
    return out


def test_pipeline(spark, folder, library):
    """Each stage's rows redone from its own input in plain Python."""
    from tidemark.llm.common import word_count
    from tidemark.session import write_and_reread
    from test_texts import plain_bayes, plain_components, plain_distances

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(write_and_reread(stage(spark, kept[-1], folder), "stage"))
        assert name == corpus_pipeline.STAGES[-1][0] or kept[-1].columns == columns
    ids = [sorted(r[0] for r in k.select("doc_id").collect()) for k in kept]
    rows = {r["doc_id"]: (r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()}
    texts = {i: r[1] for i, r in rows.items()}

    counts = {i: dict(zip(quality.COUNTS, quality.counts(t.encode() if t else None))) for i, t in texts.items()}
    passed = [i for i, c in counts.items() if c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"]]
    far = plain_distances([(*rows[i][2:], counts[i]) for i in passed], 100)
    assert ids[1] == sorted(i for i, d in zip(passed, far) if d <= quality.chi2_limit(1 - 1e-6, 6))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [i for i in passed if labels.get(i) == 1]
    assert len(set(good) & set(ids[1])) >= 0.99 * len(good)

    told = plain_bayes([rows[i] for i in ids[1]])
    assert ids[2] == [i for i, (lang, score) in zip(ids[1], told) if lang != "und" and score >= 0.5]

    prints = {i: simhash.fingerprint(texts[i].encode(), 3) & (1 << 64) - 1 for i in ids[2]}
    order = sorted(prints)
    assert ids[3] == sorted(set(plain_components([(i, prints[i]) for i in order])))

    sized = kept[3].select("doc_id", "source", word_count("text").alias("size"))
    hashed = sized.select("*", F.xxhash64(F.lit(42), "doc_id", "size")).collect()
    assert Counter(ids[4]) == +plain_copies([tuple(r) for r in hashed])

    encoded = kept[5].collect()
    assert sorted(r["doc_id"] for r in encoded) == ids[4]
    for r in encoded:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == want and r["n_tokens"] == len(want)
