"""Token-id files: encoded documents in key order, in range-coded blocks that stand alone."""

from __future__ import annotations

import os
import re
import zlib
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, rangecoder
from tidemark.llm.common import gather_runs, slices
from tidemark.session import scratch_path

BLOCK = 1 << 16  # ids
HELD = 32  # blocks that are coded or decoded at once
CALL = 1000  # pieces in a call of the library
KNOWN, KNOWN_IDS = 800_000, 8_000_000  # words and pieces that a worker remembers, and ids of them
# The pattern of bpe.PIECE for words in normal form, between line feeds, of characters below U+0530 (Latin to Cyrillic).
EXOTIC = re.compile(r"[\u0530-\U0010ffff]|<\|")
PLAIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\w\n\x85\xa0]|_)+|\n")
# The same for bytes: kinds of ASCII; ODD are those that may start a contraction or a special token, and all beyond ASCII.
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
KIND = np.array([SPACE if b in b" \t\n\v\f\r" else ODD if b > 127 or b in b"'<" else LETTER if bytes([b]).isalpha() else
                 DIGIT if bytes([b]).isdigit() else OTHER for b in range(256)], np.uint8)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
PART_BYTES = 256 << 20  # of text in a part at most, or the shuffle's number of parts where that is more
PREFIX = 32
PIECES = "array<struct<ordinal:long,key:{key},n:int>>"


class LibraryPieces:
    """Encodes each piece that is new to a worker with the tokenizers library, and looks up the others."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.text, self.library = text, Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        # The model ends each piece with a token of its suffix, so many pieces can go in one call.
        suffix = self.library.model.end_of_word_suffix
        if not suffix:
            raise ValueError("pieces are told apart by the suffix of their last token; the tokenizer file names none")
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.library.model._resize_cache(0)  # every piece comes once
        self.library.normalizer = None
        self.library.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.chars = {b: ord(c) for b, c in enumerate(bpe.byte_symbols())}
        self.chars[ord("\n")] = ord(" ")
        self.forget()

    def forget(self) -> None:
        self.index, self.runs = {}, bpe.Runs()

    @cached_property
    def whole(self):
        """The library with all of its steps, for words that it cuts itself."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self.text)
        whole.no_truncation()
        whole.no_padding()
        return whole

    def call(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty pieces, which hold no line feed, in one array, and the number of ids of each."""
        ids, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), CALL):
            some = pieces[i:i + CALL]
            joined = "\n".join(some).encode().decode("latin-1").translate(self.chars)
            ids.append(np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32))
            lengths.append(np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1))
            if len(lengths[-1]) != len(some) or lengths[-1].sum() != len(ids[-1]):
                raise ValueError("the tokens of a piece do not end with the suffix")
        return np.concatenate(ids), np.concatenate(lengths)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Like `call`, but only pieces that are new reach the library."""
        distinct = list(dict.fromkeys(pieces))
        _, new = numbered(self.index, distinct)
        self.runs.append(*self.call([distinct[i] for i in new]))
        return self.runs.take(np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces)))


def numbered(index: dict, keys: list) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key, which all differ, and the places of those that are new; their numbers follow on."""
    at = np.fromiter(map(index.get, keys, repeat(-1)), np.int64, len(keys))
    new = np.flatnonzero(at < 0)
    at[new] = np.arange(len(index), len(index) + len(new))
    index.update(zip([keys[i] for i in new], at[new].tolist()))
    return at, new


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of texts that hold no NULL, one after the other, and the number of pieces of each.

    Words without odd characters are cut into lower-case runs of letters, single
    digits and runs of others, as the tokenizer's pattern does; others stay whole.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets -= offsets[0]
    if not len(raw):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    kind = KIND.take(raw)
    solid = kind != SPACE
    opens = np.ones(len(raw) + 1, bool)  # of words
    np.logical_not(solid[:-1], out=opens[1:-1])
    opens[offsets] = True
    opens = opens[:-1][solid]
    data, kind = raw[solid], kind[solid]
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    starts = np.flatnonzero(opens)
    whole = np.repeat(np.maximum.reduceat(kind, starts) == ODD, np.diff(starts, append=len(data)))
    inner = kind == DIGIT
    inner[1:] |= kind[1:] != kind[:-1]
    opens |= inner & ~whole
    starts = np.flatnonzero(opens)
    data = np.where(whole, data, LOWER.take(data))
    ends = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
    solid[solid] = opens  # now the places where pieces start
    return pieces, np.diff(np.searchsorted(np.flatnonzero(solid), offsets))


class LibraryEncoder(bpe.Encoder):
    """Encodes each piece, or word with odd characters, that is new to a worker with the tokenizers library, and looks up the others."""

    def make_merges(self, text: str) -> LibraryPieces:
        return LibraryPieces(text)

    def forget(self) -> None:
        self.index, self.runs = {}, bpe.Runs()
        self.merges.forget()

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that hold no ASCII white space in one array, and the number of ids of each; the library cuts exotic ones."""
        odd = np.array([bool(EXOTIC.search(w)) for w in words], bool)
        order = np.argsort(odd, kind="stable")
        n = len(words) - int(odd.sum())
        ids, lengths = self.joined(PLAIN.findall(self.normal("\n".join([words[i] for i in order[:n]]))), n)
        if n < len(words):
            found = [e.ids for e in self.merges.whole.encode_batch_fast([words[i] for i in order[n:]], add_special_tokens=False)]
            ids = np.concatenate([ids, *(np.array(x, np.int32) for x in found)])
            lengths = np.append(lengths, list(map(len, found)))
        return in_order(ids, lengths, order)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each; NULL has none."""
        if len(self.index) > KNOWN or self.runs.used > KNOWN_IDS:
            self.forget()
        pieces, counts = cut_texts(pc.fill_null(texts.cast(pa.string()), ""))
        pieces = pieces.dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at, new = numbered(self.index, distinct)
        fresh = [distinct[i] for i in new]
        odd = np.array([not w.isascii() or "'" in w or "<" in w for w in fresh], bool)
        order = np.argsort(odd, kind="stable")
        n = len(fresh) - int(odd.sum())
        some, others = self.merges.call([fresh[i] for i in order[:n]]), self.ids_of([fresh[i] for i in order[n:]])
        self.runs.append(*in_order(*map(np.concatenate, zip(some, others)), order))
        ids, lengths = self.runs.take(at[pieces.indices.to_numpy()])
        return ids, np.diff(np.append(0, np.cumsum(lengths))[np.cumsum(counts)], prepend=0)

    def encode_batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_column(pa.array(texts, pa.binary()))


def in_order(ids: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids that lie in an order, and their lengths, put back."""
    back = np.argsort(order, kind="stable")
    return gather_runs(ids, (np.cumsum(lengths) - lengths)[back], lengths[back]), lengths[back]


class Cutter:
    """Gathers documents' ids into blocks and remembers whose ids each block holds."""

    def __init__(self):
        self.ids, self.pieces, self.held = [], [], 0
        self.ordinal = self.block = self.start = 0

    def add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids.append(ids)
        self.pieces += zip(range(self.ordinal, self.ordinal + len(keys)), keys, lengths.tolist())
        self.held += len(ids)
        self.ordinal += len(keys)

    def take(self, blocks: int | None = None) -> list[tuple[int, int, np.ndarray, list]]:
        """(block, start, ids, pieces) of the next full blocks, or of all that is left, where the last two are halves of their ids."""
        flat = np.concatenate(self.ids) if self.ids else np.empty(0, np.int32)
        upto = len(flat) if blocks is None else blocks * BLOCK
        edges = [*range(0, upto, BLOCK), upto]
        if blocks is None and len(edges) > 2:
            edges[-2] = (edges[-3] + upto) // 2  # a short block has few lanes
        out, pieces, i, left = [], self.pieces, 0, self.pieces[0][2] if self.pieces else 0
        for a, b in zip(edges, edges[1:]):
            part = flat[a:b]
            room, own = len(part), []
            while room:
                n = min(left, room)
                own.append((pieces[i][0], pieces[i][1], n))
                room, left = room - n, left - n
                if not left and i + 1 < len(pieces):
                    i += 1
                    left = pieces[i][2]
            out.append((self.block, self.start, part, own))
            self.block += 1
            self.start += len(part)
        self.ids, self.held = [flat[upto:]], len(flat) - upto
        self.pieces = [(*pieces[i][:2], left), *pieces[i + 1:]] if self.held else []
        return out


def write(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, key: str = "doc_id",
          text: str = "text") -> str:
    """Write the ids of every whole text and `end_id` in ascending order of the key; returns the path.

    A range exchange by key and the first characters of the text cuts the order
    into parts of like size; their number follows the bytes of all texts. Only
    keys and those characters are sampled. Each part is a line of ids, cut into blocks without regard to documents. A block is coded
    on its own by the adaptive coder, with its length and checksum. The file's
    rows are blocks: part, block, start (ids of the part before it), n_ids, the
    coded payload, and the documents whose ids it holds, in order. NULL texts
    have the end id alone; NULL keys come first; rows with one key lie in the
    order of their texts. Without documents there are no blocks.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    shared = spark.sparkContext.broadcast(bpe.read_vocabulary(vocabulary))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    ordered = rows.repartitionByRange(parts, F.col("key"), F.substring("text", 1, PREFIX)).sortWithinPartitions("key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"part int, block int, start long, n_ids int, payload binary, pieces {PIECES.format(key=kind)}"

    def run(batches):
        coder, cutter = bpe.encoder(shared.value, LibraryEncoder), Cutter()
        alphabet, part_id = max(coder.merges.size, end_id + 1), TaskContext.get().partitionId()

        def coded(lot):
            payloads = rangecoder.encode_blocks([b[2] for b in lot], alphabet)
            return pa.RecordBatch.from_pylist(
                [{"part": part_id, "block": b, "start": s, "n_ids": len(ids), "payload": p,
                  "pieces": [{"ordinal": o, "key": k, "n": n} for o, k, n in own]}
                 for (b, s, ids, own), p in zip(lot, payloads)], schema=arrow)

        arrow = None
        for batch in batches:
            if arrow is None:
                piece = pa.struct([("ordinal", pa.int64()), ("key", batch.schema.field("key").type), ("n", pa.int32())])
                arrow = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()),
                                   ("payload", pa.binary()), ("pieces", pa.list_(piece))])
            for some in slices(batch, "text"):
                ids, n = coder.encode_column(some.column("text"))
                cutter.add(some.column("key").to_pylist(), np.insert(ids, np.cumsum(n), end_id), n + 1)
                while cutter.held >= (HELD + 2) * BLOCK:
                    yield coded(cutter.take(HELD))
        if cutter.held:
            yield coded(cutter.take())

    ordered.mapInArrow(run, schema).write.parquet(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, ordinal, key, start, ids) of the pieces of documents in each block, decoded and checked.

    start counts the part's ids before the piece. A document that runs over the
    end of a block has several pieces. A damaged block fails the read.
    """
    table = spark.read.parquet(path)
    kind = table.schema["pieces"].dataType.elementType["key"].dataType.simpleString()
    return table.mapInArrow(_decoder(_piece_rows), f"part int, block int, ordinal long, key {kind}, start long, ids array<int>")


def _decoder(rows_of):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, HELD):
                some = batch.slice(i, HELD)
                blocks = rangecoder.decode_blocks(some.column("payload").to_pylist())
                names = ["part", "block", "start", "pieces"]
                yield rows_of(zip(*[some.column(c).to_pylist() for c in names], blocks), some.schema)
    return run


def _key_type(schema):
    return schema.field("pieces").type.value_type.field("key").type


def _piece_rows(blocks, schema):
    rows = []
    for part, block, start, pieces, ids in blocks:
        at = 0
        for p in pieces:
            rows.append((part, block, p["ordinal"], p["key"], start + at, ids[at:at + p["n"]]))
            at += p["n"]
    columns = list(zip(*rows)) if rows else [[]] * 6
    kinds = [pa.int32(), pa.int32(), pa.int64(), _key_type(schema), pa.int64(), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["part", "block", "ordinal", "key", "start", "ids"])


def _checksum_rows(blocks, schema):
    rows = []
    for part, block, start, pieces, ids in blocks:
        at, wide = 0, ids.astype("<u4")
        for p in pieces:
            rows.append((part, block, p["ordinal"], p["key"], start + at, p["n"], zlib.crc32(wide[at:at + p["n"]])))
            at += p["n"]
    columns = list(zip(*rows)) if rows else [[]] * 7
    kinds = [pa.int32(), pa.int32(), pa.int64(), _key_type(schema), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["part", "block", "ordinal", "key", "start", "n", "crc"])


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the CRC-32 polynomial, top bit first."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(crcs, lengths) -> int:
    """CRC-32 of byte runs in a row from the CRC-32 of each: the sum so far times x^(8 * length), plus the next."""
    total = 0
    for crc, length in zip(crcs, lengths):
        power, square, bits = 0x80000000, 0x40000000, 8 * int(length)
        while bits:
            if bits & 1:
                power = _times(power, square)
            square, bits = _times(square, square), bits >> 1
        total = _times(power, total) ^ int(crc)
    return total


def _times_each(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`_times` of two arrays, element by element."""
    out, one = np.zeros_like(a), np.uint32(1)
    for _ in range(32):
        out ^= np.where(a >> np.uint32(31), b, np.uint32(0))
        a = a << one
        b = b >> one ^ np.where(b & one, np.uint32(0xEDB88320), np.uint32(0))
    return out


def joined_crcs(crcs: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`joined_crc` of many runs at once; run i has the next counts[i] of the parts' checksums and lengths."""
    crcs, powers, square = crcs.astype(np.uint32), np.full(len(crcs), 0x80000000, np.uint32), 0x40000000
    bits = 8 * lengths.astype(np.int64)
    while bits.any():
        odd = np.flatnonzero(bits & 1)
        powers[odd] = _times_each(powers[odd], np.full(len(odd), square, np.uint32))
        square, bits = _times(square, square), bits >> 1
    starts, total = np.cumsum(counts) - counts, np.zeros(len(counts), np.uint32)
    for i in range(int(counts.max(initial=0))):
        at = np.flatnonzero(counts > i)
        own = starts[at] + i
        total[at] = _times_each(powers[own], total[at]) ^ crcs[own]
    return total.astype(np.int64)


def summary(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) per document, all from the decoded file.

    start is the number of ids of all documents before it. Pieces of one
    document meet by part and ordinal, at most its length over the block length
    of them; the window over parts has one row per part.
    """
    table = spark.read.parquet(path)
    kind = table.schema["pieces"].dataType.elementType["key"].dataType.simpleString()
    pieces = table.mapInArrow(
        _decoder(_checksum_rows), f"part int, block int, ordinal long, key {kind}, start long, n long, crc long")
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = sizes.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))

    @F.arrow_udf("long")
    def crc(column: pa.Array) -> pa.Array:
        parts = column.flatten()
        crcs, n = (parts.field(c).to_numpy(zero_copy_only=False) for c in ("crc", "n"))
        counts = np.diff(column.offsets.to_numpy())
        return pa.array(joined_crcs(crcs, 4 * n, counts), pa.int64())

    docs = pieces.groupBy("part", "ordinal").agg(
        F.first("key").alias(key), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"))
    return docs.join(before, "part").select(
        key, (F.col("before") + F.col("start")).alias("start"), "n_tokens", crc("pieces").alias("ids_crc32"))
