"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemark.llm.common import as_bytes, gather_runs, slices

# What the tokenizer file's own pattern and white-space class stand for.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and numbers that are newer than Unicode 16, which the tokenizers library knows no more than that.
NEWER = (
    r"\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd-\ua7e2\ua7f1\uab6c\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011df1"
    r"\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016ed3\U00016ff2-\U00016ff6"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001dfff\U0001e6c0-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U0003fc3f"
)
LETTER, NUMBER = rf"[\p{{L}}--[{NEWER}]]", rf"[\p{{N}}--[{NEWER}]]"
PIECE = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{LETTER}+|{NUMBER}|(?:[^{SPACE}\p{{L}}\p{{N}}]|[{NEWER}])+"
NONE = np.int32(2**31 - 1)
KNOWN_WORDS = 200_000
SLICE = 4 << 20
IDS = ArrayType(IntegerType())


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    own = set(prints)
    return [chr(b) if b in own else chr(next(shifted)) for b in range(256)]


class Merges:
    """Vocabulary and merge table of a word-level byte BPE as arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [p.split(" ", 1) if isinstance(p, str) else p for p in model["merges"]]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        at = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in pairs], dtype=np.int64).reshape(-1, 3)
        made = np.full(self.size, -1, dtype=np.int64)
        made[at[:, 2]] = np.arange(len(at))
        if len(set(at[:, 2].tolist())) < len(at) or (made[at[:, :2]] >= np.arange(len(at))[:, None]).any():
            raise ValueError("merge rounds need merges that only join symbols made before them, each in one way")
        keys = at[:, 0] * self.size + at[:, 1]
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, NONE).astype(np.int32)
        self.made = np.append(at[:, 2], 0).astype(np.int32)  # by rank
        chars = byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int32)
        self.last = np.array([vocab[c + suffix] for c in chars], dtype=np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair by binary search, NONE where the pair never merges."""
        key = left.astype(np.int64) * self.size + right
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.ranks[place], NONE)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty pieces in one array, and the number of ids of each.

        Every round merges, in each word, all places of its lowest-ranked pair
        from left to right, and looks up only the pairs next to a merge.
        """
        pieces = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if not len(lengths):
            return np.empty(0, np.int32), lengths
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(lengths) - 1
        symbol = self.inner[raw]
        symbol[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        rank = np.full(len(symbol), NONE)
        rank[:-1] = np.where(word[:-1] == word[1:], self.rank(symbol[:-1], symbol[1:]), NONE)
        done = []
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            best = np.repeat(best, np.diff(starts, append=len(word)))
            live = best < NONE
            if not live.all():
                done.append((word[~live], symbol[~live]))
                symbol, word, rank, best = symbol[live], word[live], rank[live], best[live]
                if not len(symbol):
                    break
            hit = rank == best
            chain = hit[1:] & hit[:-1] & (word[1:] == word[:-1])
            if chain.any():  # one symbol repeated: every other place
                at = np.arange(len(hit))
                opens = hit.copy()
                opens[1:] &= ~chain
                hit &= (at - np.maximum.accumulate(np.where(opens, at, 0))) % 2 == 0
            at = np.flatnonzero(hit)
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # ends of words stay ends
            fresh = np.zeros(len(symbol), bool)
            fresh[at] = True
            symbol, word, rank, fresh = symbol[keep], word[keep], rank[keep], fresh[keep]
            fresh[:-1] |= fresh[1:]
            look = np.flatnonzero(fresh[:-1] & (word[:-1] == word[1:]))
            rank[look] = self.rank(symbol[look], symbol[look + 1])
            rank[-1] = NONE
            rank[:-1][word[:-1] != word[1:]] = NONE
        word, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(pieces))


class Index(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = place = len(self)
        return place


class Runs:
    """Runs of ids, by number."""

    def __init__(self):
        self.flat, self.used = np.empty(1 << 20, np.int32), 0
        self.starts = self.lengths = np.empty(0, np.int64)

    def append(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts = np.append(self.starts, self.used + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.used += len(ids)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs `at` in one array, and the number of ids of each."""
        lengths = self.lengths[at]
        return gather_runs(self.flat, self.starts[at], lengths), lengths


class Encoder:
    """Encodes texts word by word; ids of words met before are looked up.

    White space ends every piece of the pattern, so the ids of a text are the
    ids of its words in a row. `KNOWN_WORDS` bounds the memory of the table.
    """

    def __init__(self, text: str):
        self.merges = self.make_merges(text)
        special = "|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        self.pieces = regex.compile(rf"{PIECE}|\n")
        self.forget()

    def make_merges(self, text: str):
        return Merges(text)

    def forget(self):
        self.index, self.runs = Index(), Runs()

    def normal(self, text: str) -> str:
        # Every character is lowered alone: no special case for a sigma that ends a word.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that hold no ASCII white space in one array, and the number of ids of each."""
        parts, fixed = [], []  # texts that are encoded, and per word what takes their place, if not one of them
        for i, t in enumerate(texts):
            if self.special and "<|" in t and len(cut := self.special.split(t)) > 1:
                fixed.append((i, cut))
                parts += cut[::2]
            else:
                parts.append(t)
        ids, lengths = self.joined(self.pieces.findall(self.normal("\n".join(parts))) if parts else [], len(parts))
        return self.insert(ids, lengths, fixed, len(texts)) if fixed else (ids, lengths)

    def joined(self, found: list[str], count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of `count` words in one array, and the number of ids of each, from their pieces, which line feeds part."""
        cuts = np.array([p == "\n" for p in found], dtype=bool)
        ids, n = self.merges.encode([p for p in found if p != "\n"])
        owner = np.cumsum(cuts)[~cuts] if len(found) else np.empty(0, np.int64)
        return ids, np.bincount(owner, weights=n, minlength=count).astype(np.int64)

    def insert(self, ids, lengths, fixed, count):
        """Put special ids between the parts of the words that hold them."""
        runs, out, at, part = np.split(ids, np.cumsum(lengths)[:-1]), [], dict(fixed), 0
        for i in range(count):
            cut = at.get(i, [None])
            pieces = []
            for j, c in enumerate(cut):
                if j % 2:
                    pieces.append(np.array([self.merges.special[c]], np.int32))
                else:
                    pieces.append(runs[part])
                    part += 1
            out.append(np.concatenate(pieces))
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def encode_batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each; None is empty."""
        if len(self.index) > KNOWN_WORDS:
            self.forget()
        known = len(self.index)
        at, counts = [], []
        for t in texts:
            words = t.split() if t else ()
            counts.append(len(words))
            at.extend(map(self.index.__getitem__, words))
        if len(self.index) > known:
            self.runs.append(*self.ids_of([w.decode() for w in list(self.index)[known:]]))
        ids, lengths = self.runs.take(np.array(at, dtype=np.int64))
        text = np.repeat(np.arange(len(texts)), counts)
        return ids, np.bincount(text, weights=lengths, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: list) -> bytes:
        """The tokens of the ids, set apart by spaces, as the file names no decoder."""
        return b" ".join(map(self.merges.tokens.__getitem__, ids))


_made: dict = {}


def encoder(text: str, kind=Encoder):
    """One encoder per Python worker and vocabulary."""
    if (kind, text) not in _made:
        _made.clear()
        _made[kind, text] = kind(text)
    return _made[kind, text]


def read_vocabulary(path: str) -> str:
    """The tokenizer file, read by the driver; a vocabulary does not grow with the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, keep=("doc_id",), text: str = "text") -> DataFrame:
    """(keep..., ids array<int>) of every whole text; NULL and empty texts have no ids.

    `vocabulary` is the path of a tokenizer file. Other columns of `docs` may
    have any names, as only `keep` and the text are read. Repeated rows give
    repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))

    def run(batches):
        coder = encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "__text", SLICE):
                ids, n = coder.encode_batch(as_bytes(part.column("__text")))
                offsets = pa.array(np.append(0, np.cumsum(n)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))],
                    [*keep, "ids"])
        coder.forget()

    schema = rows.select(*keep).schema.add("ids", IDS)
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the decoded text of each row of ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        coder = encoder(shared.value)
        return pa.array([None if x is None else coder.decode(x).decode() for x in column.to_pylist()], pa.string())

    return encoded.withColumn(name, text_of(ids))


def digests(docs: DataFrame, vocabulary: str, keep=("doc_id",), text: str = "text", with_ids: bool = False) -> DataFrame:
    """(keep..., n_tokens, ids_sha256, decoded_sha256[, ids]): encode and decode in one pass over the texts.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded
    text in UTF-8. Ids and decoded text never leave the Python worker unless
    `with_ids` asks for the ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))

    def run(batches):
        coder = encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "__text", SLICE):
                ids, n = coder.encode_batch(as_bytes(part.column("__text")))
                offsets = np.append(0, np.cumsum(n))
                wide = ids.astype("<u4")
                hashed, decoded = [], []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    hashed.append(hashlib.sha256(wide[a:b]).hexdigest())
                    decoded.append(hashlib.sha256(coder.decode(ids[a:b].tolist())).hexdigest())
                columns = [*[part.column(c) for c in keep], pa.array(n, pa.int64()), pa.array(hashed, pa.string()),
                           pa.array(decoded, pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    columns, [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
        coder.forget()  # the worker goes on to other tasks

    schema = rows.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return rows.mapInArrow(run, schema.add("ids", IDS) if with_ids else schema)
