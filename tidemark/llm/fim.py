"""Fill-in-the-middle documents: cuts located by rank queries on a wavelet matrix over character classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_text, slices

# Kinds of bytes; the fourth bit of a class tells the first byte of a line.
CONTINUATION, BLANK, NEWLINE, WORD_START, INSIDE = range(5)
LINE_START = 8
CLASS_BITS = 4
# Classes whose bytes begin a unit.
UNITS = {
    "characters": [k + f for f in (0, LINE_START) for k in (BLANK, NEWLINE, WORD_START, INSIDE)],
    "words": [WORD_START, WORD_START + LINE_START],
    "lines": [k + LINE_START for k in range(5)],
}
MARKERS = ("<P>", "<S>", "<M>")
CUT_SCHEMA = "n long, prefix_chars long, middle_chars long, prefix string, middle string, suffix string"


class BitVector:
    """Bits with the number of ones before each position, counted per word of 64 and within it."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of each class in any prefix of a sequence, in as many steps as a class has bits.

    A level holds one bit of every element, from the highest bit down; the
    elements with a zero go before those with a one on the next level.
    """

    def __init__(self, codes: np.ndarray, bits: int = CLASS_BITS):
        self.length, self.levels = len(codes), []
        for shift in reversed(range(bits)):
            ones = (codes >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(ones), len(codes) - int(ones.sum())))
            codes = np.concatenate([codes[~ones], codes[ones]])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """Elements of class `code` among the first `at`."""
        first = np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            a, b = ones.rank(first), ones.rank(at)
            first, at = (zeros + a, zeros + b) if code >> shift & 1 else (first - a, at - b)
        return at - first

    def count(self, codes, at: np.ndarray) -> np.ndarray:
        """Elements of any of the classes among the first `at`: the sum of their ranks."""
        return sum(self.rank(c, at) for c in codes)


def byte_classes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that lie one after another, beginning at `starts`."""
    kinds = np.full(256, INSIDE, np.uint8)
    kinds[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    kinds[0x0A] = NEWLINE
    kinds[0x80:0xC0] = CONTINUATION
    kind = kinds[flat]
    previous = np.empty_like(kind)
    previous[1:] = kind[:-1]
    previous[starts[starts < len(flat)]] = NEWLINE
    space = (previous == NEWLINE) | (previous == BLANK)
    codes = np.where((kind == INSIDE) & space, np.uint8(WORD_START), kind)
    return codes + np.where(previous == NEWLINE, np.uint8(LINE_START), np.uint8(0))


def cut_places(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, draws, unit: str):
    """(n, cuts, places): units of each text, units before each of two cuts, and the cuts' byte places.

    n comes from two ranks. A cut after k units is the last place with no more
    than k begun units before it, found for all texts at once by bisection on
    the ranks.
    """
    matrix = WaveletMatrix(byte_classes(flat, starts))
    begin = UNITS[unit]
    base = matrix.count(begin, starts)
    n = matrix.count(begin, ends) - base
    picked = [np.where(d >= 0, d, 0) % (n + 1) for d in draws]
    cuts = np.minimum(*picked), np.maximum(*picked)
    places = []
    for k in cuts:
        low, high = starts.copy(), ends.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = matrix.count(begin, middle) - base <= k
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        places.append(low)
    return n, cuts, places


def cut_texts(texts: pa.Array, first: pa.Array, second: pa.Array, unit: str) -> pa.StructArray:
    """The units of each text and its three parts; NULL is an empty text."""
    whole = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    n, (a, b), (p, q) = cut_places(flat, starts, ends, [x.to_numpy(zero_copy_only=False) for x in (first, second)], unit)

    def parts(frm, to):
        return pa.array([bytes(flat[x:y]) for x, y in zip(frm.tolist(), to.tolist())], pa.binary()).cast(pa.string())

    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(a), pa.array(b - a), parts(starts, p), parts(p, q), parts(q, ends)],
        [field.split()[0] for field in CUT_SCHEMA.split(", ")])


def cut(text: Column, first: Column, second: Column, unit: str = "characters") -> Column:
    """(n, prefix_chars, middle_chars, prefix, middle, suffix) of a text of n units.

    The cuts lie after first % (n + 1) and second % (n + 1) units, the smaller
    one first. Units are characters (code points), words or lines; blanks before
    the first word belong to the first part, other blanks to the word before.
    """
    @F.arrow_udf(CUT_SCHEMA)
    def of(texts: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts, a, b], ["text", "a", "b"])
        done = [cut_texts(*part.columns, unit) for part in slices(batch, "text")]
        return pa.concat_arrays(done) if done else cut_texts(texts, a, b, unit)

    return of.asNondeterministic()(text, first, second)


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of "seed:key"; a NULL key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, unit: str = "characters",
              plain_percent: int = 10, spm_percent: int = 20, markers=MARKERS) -> DataFrame:
    """Add the column fim: (n, form, prefix_chars, middle_chars, output).

    Forms are plain (the text as it is), psm (prefix, suffix, middle) and spm
    (suffix, prefix, middle), the parts after their markers. A text is plain if
    it is empty or holds a marker, or by its draw. Draws depend on seed and key
    alone, so reruns agree and repeated rows get one result.

    NULL texts count as empty; a column named fim is replaced, all others stay.
    prefix_chars and middle_chars count units, and are NULL for plain texts. An
    empty table gives an empty one. A text is handled whole, however long it is.
    """
    prefix, suffix, middle = markers
    h1, h2, h3, h4 = draws(F.col(key), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    holds = [F.contains(whole, F.lit(m)) for m in markers]
    plain = (whole == "") | holds[0] | holds[1] | holds[2] | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    cuts = docs.withColumn("__cut", cut(F.col(text), h1, h2, unit)).withColumn("__form", form)
    c = F.col("__cut")
    output = F.when(F.col("__form") == "plain", whole).when(
        F.col("__form") == "psm", F.concat(F.lit(prefix), c["prefix"], F.lit(suffix), c["suffix"], F.lit(middle), c["middle"])
    ).otherwise(F.concat(F.lit(suffix), c["suffix"], F.lit(prefix), c["prefix"], F.lit(middle), c["middle"]))

    def told(name):
        return F.when(F.col("__form") != "plain", c[name]).alias(name)

    return cuts.withColumn("fim", F.struct(
        c["n"].alias("n"), F.col("__form").alias("form"), told("prefix_chars"), told("middle_chars"),
        output.alias("output"))).drop("__cut", "__form")


def restore_text(output: bytes, form: str, markers=MARKERS) -> bytes:
    """The text that an output was made from; the first marker after a part ends it, as no text with a marker is cut."""
    if form == "plain":
        return output
    prefix, suffix, middle = (m.encode() for m in markers)
    one, two = (prefix, suffix) if form == "psm" else (suffix, prefix)
    second = output.index(two, len(one))
    third = output.index(middle, second + len(two))
    a, b, c = output[len(one):second], output[second + len(two):third], output[third + len(middle):]
    return a + c + b if form == "psm" else b + c + a


def restored(output: Column, form: Column, markers=MARKERS) -> Column:
    """The text rebuilt from output and form alone."""
    @F.arrow_udf("string")
    def of(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        back = [restore_text(o, f, markers) for o, f in zip(each_text(outputs), forms.to_pylist())]
        return pa.array(back, pa.binary()).cast(pa.string())

    return of(output, form)
