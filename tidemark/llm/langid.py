"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_text
from tidemark.operators.bounded import stored

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BITS = 15
PIECE = 1 << 20
# Odd multipliers of the hash; any do.
STEP, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)

_letters: list = []


def letters() -> np.ndarray:
    """For each code point the lower-case letter, or a space for all that is no letter."""
    if not _letters:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _letters.append(table)
    return _letters[0]


def gram_counts(text: str, orders=ORDERS, bits: int = BITS) -> np.ndarray | None:
    """How often each hashed n-gram of letters and word ends occurs; None without any letter.

    Letters are lowered and all between two letters is one space. Long texts
    are counted piece by piece; pieces overlap, so no n-gram is lost.
    """
    low = letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    is_letter = low != 32
    if not is_letter.any():
        return None
    low = np.concatenate([[np.uint32(32)], low[is_letter | np.append(True, is_letter[:-1])], [np.uint32(32)]])
    total = np.zeros(1 << bits, np.int64)
    for at in range(0, len(low), PIECE):
        own = min(PIECE, len(low) - at)
        part = low[at:at + own + max(orders) - 1]
        code = np.zeros(len(part), np.uint32)
        for n in range(1, max(orders) + 1):
            m = len(part) - n + 1
            if m < 1:
                break
            code = code[:m] * STEP + part[n - 1:n - 1 + m] + np.uint32(1)
            if n in orders:
                total += np.bincount((code[:own] * SPREAD) >> np.uint32(32 - bits), minlength=1 << bits)
    return total


class Model:
    """Log-probabilities, a row per hashed n-gram and a column per language."""

    def __init__(self, languages: list[str], weights: np.ndarray, bits: int):
        self.languages, self.weights, self.bits = languages, weights, bits

    def scores(self, text: str | None) -> np.ndarray | None:
        """The log-likelihood of each language; None where nothing can be told."""
        found = gram_counts(text, bits=self.bits) if text else None
        if found is None or not self.languages:
            return None
        used = np.flatnonzero(found)
        return found[used] @ self.weights[used]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its posterior with even priors); unknown, 0 where nothing can be told."""
        score = self.scores(text)
        if score is None:
            return UNKNOWN, 0.0
        best = int(score.argmax())  # on a tie the first in code-point order
        return self.languages[best], float(1 / np.exp(score - score[best]).sum())


class ModelBlocks:
    """A model of any number of languages in blocks of columns, each a broadcast of its own.

    Texts are scored block after block; of each text the best language so far,
    its score and the sum of all likelihoods against it are kept.
    """

    def __init__(self, blocks: list):
        self.blocks = blocks

    def predict_all(self, texts: list) -> list[tuple[str, float]]:
        best: list = [None] * len(texts)
        for block in self.blocks:
            model = block.value
            for i, text in enumerate(texts):
                score = model.scores(text)
                if score is None:
                    continue
                at = int(score.argmax())
                name, top, rest = model.languages[at], float(score[at]), float(np.exp(score - score[at]).sum())
                if best[i] is not None:
                    old, high, sum_ = best[i]
                    if top > high:  # on a tie the first in code-point order, as blocks are in that order
                        rest += sum_ * np.exp(high - top)
                    else:
                        name, top, rest = old, high, sum_ + rest * np.exp(top - high)
                best[i] = name, top, rest
        return [(UNKNOWN, 0.0) if b is None else (b[0], float(1 / b[2])) for b in best]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 4000,
          smoothing: float = 0.5, bits: int = BITS, block: int = 256) -> list[Model]:
    """Fit on about `per_language` rows of each language (all, where there are fewer), chosen by the hash of the key.

    `labelled` may hold NULLs; rows without text or language teach nothing, and
    repeated rows teach as often as they occur. The n-gram counts are summed by
    Spark. The model comes in blocks of `block` languages in code-point order:
    the driver holds one block's counts at a time on the way to its broadcast,
    block x 2^bits of them. What is broadcast grows with the number of languages,
    not of texts. An empty or unlabelled table has no blocks.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    rows = rows.dropna(subset=["text", "lang"])
    sizes = rows.groupBy("lang").agg(F.expr(f"least({1 << 30}L, {per_language} * {1 << 30}L div count(*))").alias("part"))
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())
    if not languages:
        return []
    sample = rows.join(stored(sizes), "lang").filter(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) < F.col("part"))

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for t, name in zip(each_text(batch.column("text")), batch.column("lang").to_pylist()):
                found = gram_counts(t.decode(), bits=bits)
                if found is not None:
                    sums[name] = found if name not in sums else sums[name] + found
        for name, found in sums.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(found[used], pa.int64())],
                ["lang", "gram", "n"])

    counted = sample.select("text", "lang").mapInArrow(run, "lang string, gram int, n long")
    sums = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    if len(languages) > block:
        sums = stored(sums)
    blocks = []
    for i in range(0, len(languages), block):
        own = languages[i:i + block]
        table = (sums if len(languages) <= block else sums.filter(F.col("lang").between(own[0], own[-1]))).toArrow()
        counts = np.zeros((1 << bits, len(own)))
        if table.num_rows:
            at = {name: i for i, name in enumerate(own)}
            column = np.array([at[x] for x in table.column("lang").to_pylist()])
            counts[table.column("gram").to_numpy(), column] = table.column("n").to_numpy()
        counts += smoothing
        blocks.append(labelled.sparkSession.sparkContext.broadcast(Model(own, np.log(counts / counts.sum(axis=0)), bits)))
    return blocks


def predicted(docs: DataFrame, blocks: list, text: str = "text") -> Column:
    """struct(lang_pred, score) of a text column; each block of the matrix is a broadcast of block x 2^bits doubles."""
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def of(column: pa.Array) -> pa.Array:
        model, found = ModelBlocks(blocks), []
        if len(blocks) == 1:
            own = blocks[0].value
            found = [own.predict(None if t is None else t.decode()) for t in each_text(column)]
        else:
            found = model.predict_all([None if t is None else t.decode() for t in each_text(column)])
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang_pred", "score"])

    return of(text)


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: the checksum of its key falls into the fold. A NULL key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **fit) -> DataFrame:
    """(key, held_out, lang_pred, score) of every whole text, learnt from the rows that are not held out.

    Where no row teaches a language, all are unknown with score 0. Repeated rows
    get one prediction each, and an empty table gives an empty one.
    """
    model = train(docs.filter(~held_out(key)), text, lang, key, **fit)
    return docs.select(F.col(key), held_out(key).alias("held_out"), predicted(docs, model, text).alias("found")).select(
        key, "held_out", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, least: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang",
                    **fit) -> DataFrame:
    """The rows of `docs`, with their columns, whose language can be told with a posterior of `least` or more.

    Where no row teaches a language none can be told apart, and all rows with a
    letter stay. Repeated rows stay or go together; an empty table stays empty.
    """
    model = train(docs.filter(~held_out(key)), text, lang, key, **fit)
    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), predicted(docs, model, text).alias("found"))
    if not model:
        return docs.filter(F.col(text).rlike(r"\p{L}"))
    return found.filter((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least)).select("doc.*")
