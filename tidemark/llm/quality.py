"""Quality rules: plain limits first, then robust multivariate outliers per language and source."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import each_text
from tidemark.session import write_and_reread

# The characters that count as symbols, and the words in a window.
SYMBOLS = b"#*$%&|<>"
WINDOW, CHUNK = 5, 20
WHITE = b" \t\n\r\x0b\x0c"
MARKS = b".,;:!?"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_marks"]
STATISTICS = ["word_length", "symbol_rate", "dup_line_share", "repeat_share", "distinct_share", "mark_rate"]
# What the scatter of a statistic can be at least, and what is believed of it where there are no rows.
FLOORS = (0.02, 0.04, 0.09, 0.06, 0.01, 0.02)
PRIOR = (0.08, 0.04, 0.09, 0.07, 0.08, 0.06)


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word of a text, equal words alike."""
    index: dict = {}
    return np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))


def distinct_in_chunks(ids: np.ndarray, chunk: int = CHUNK) -> int:
    """Different words of each run of `chunk` words, summed; unlike those of the whole text, they grow with its length."""
    whole = len(ids) // chunk * chunk
    rows = np.sort(ids[:whole].reshape(-1, chunk), axis=1)
    return int((np.diff(rows, axis=1) != 0).sum()) + len(rows) + len(np.unique(ids[whole:]))


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, first occurrences included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    kinds, run = int(ids.max()) + 1, ids[:n].copy()
    for i in range(1, window):
        if (int(run.max()) + 1) * kinds >= 1 << 62:
            run = np.unique(run, return_inverse=True)[1]
        run = run * kinds + ids[i:n + i]
    _, place, count = np.unique(run, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(count[place] > 1)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts(text: bytes | None) -> tuple[int, ...]:
    """The COUNTS of one text; NULL has no words and no lines."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    ids = word_ids(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    inked = text.translate(None, WHITE)
    # UTF-8 bytes that go on with a character are 0x80 to 0xBF.
    chars = len(inked) if inked.isascii() else len(inked.decode())
    return (len(words), chars, len(inked) - len(inked.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(ids), len(lines), distinct_in_chunks(ids), len(inked) - len(inked.translate(None, MARKS)))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the column `counts`, a struct of the COUNTS of the whole text."""
    schema = "struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">"

    @F.arrow_udf(schema)
    def of(column: pa.Array) -> pa.Array:
        found = np.array([counts(t) for t in each_text(column)], dtype=np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(COUNTS))], COUNTS)

    # Told as not repeatable, so that a filter on the counts is not moved below and the texts are counted once.
    return docs.withColumn("counts", of.asNondeterministic()(text))


def chi2_share(x: float, freedom: int) -> float:
    """Share of a chi-square distribution below x, by the series of the incomplete gamma function."""
    a, y = freedom / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= y / k
        total += term
    return total * math.exp(a * math.log(y) - y - math.lgamma(a))


def chi2_limit(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, freedom) < share else (low, mid)
    return high


# Characters, different words (in a chunk) and marks per word, for a language without any row.
USUAL = {"chars": 5.0, "different": 0.9, "marks": 0.12}


def statistics(rates: str, pseudo_words: float = 50.0, pseudo_lines: float = 5.0, pseudo_few: float = 10.0) -> dict:
    """The transformed statistics as columns of the counts and of the struct `rates` of the row's language.

    Pseudo-words draw short texts towards an ordinary text: one of the language's
    own word length, different words and marks, and without symbols and repeats.
    Logarithms and square roots even out the spread.
    """
    n, lines = f"(counts.n_words + {pseudo_words}D)", f"(counts.n_lines + {pseudo_lines}D)"
    few = f"(counts.n_words + {pseudo_few}D)"
    return {
        "word_length": F.expr(f"ln((counts.word_chars + {rates}.chars * {pseudo_words}D) / {n})"),
        "symbol_rate": F.expr(f"sqrt(counts.n_symbols / {n})"),
        "dup_line_share": F.expr(f"sqrt(counts.n_dup_lines / {lines})"),
        "repeat_share": F.expr(f"sqrt(counts.n_repeat_words / {n})"),
        "distinct_share": F.expr(f"ln((counts.n_distinct + {rates}.different * {pseudo_few}D) / {few})"),
        "mark_rate": F.expr(f"sqrt((counts.n_marks + {rates}.marks * {pseudo_few}D) / {few})"),
    }


def _rates(passed: DataFrame) -> DataFrame:
    """(grp, rates) of every language: totals of its rows, in which a long text counts by its words."""
    per = ", ".join(f"sum(counts.{c}) / sum(double(counts.n_words)) as {name}" for c, name in (
        ("word_chars", "chars"), ("n_distinct", "different"), ("n_marks", "marks")))
    return passed.groupBy(F.col("__groups")[1].alias("grp")).agg(F.expr(f"struct({per}) as rates"))


def _distance(columns) -> str:
    p = len(columns)
    return " + ".join(
        f"({a} - centre[{i}]) * ({b} - centre[{j}]) * inverse[{i * p + j}]"
        for i, a in enumerate(columns) for j, b in enumerate(columns))


def _estimates(sums: DataFrame, columns, floors, scale: float) -> DataFrame:
    """(grp, size, centre, inverse, scatter) from the sums of each group; one row per group. The scatter is without floors."""
    p, floor = len(columns), np.square(np.array(floors, dtype=float))

    def run(batches):
        for pdf in batches:
            inside = pdf["inside"].to_numpy(float)
            first = np.array(pdf["first"].tolist(), float).reshape(-1, p)
            second = np.array(pdf["second"].tolist(), float).reshape(-1, p, p)
            mean = first / inside[:, None]
            cov = second / inside[:, None, None] - mean[:, :, None] * mean[:, None, :]
            cov = scale * (cov + cov.transpose(0, 2, 1)) / 2
            pdf["scatter"] = list(cov.reshape(len(pdf), p * p))
            cov = cov + np.einsum("ij,j->ij", np.eye(p), floor)
            pdf["centre"] = list(mean)
            pdf["inverse"] = list(np.linalg.inv(cov).reshape(len(pdf), p * p)) if len(pdf) else []
            yield pdf[["grp", "size", "centre", "inverse", "scatter"]]

    return sums.mapInPandas(run, "grp string, size long, centre array<double>, inverse array<double>, scatter array<double>")


def _cut_points(rows: DataFrame, share: float, bin_of: str, edge_of: str, by=("grp",)) -> DataFrame:
    """(by..., n, cut): the upper edge of the bin in which the share of each group's values is reached.

    Bins are fixed, so the result does not depend on how rows are dealt out.
    Rows are counted per bin before they are shuffled, and bins of one group go
    to many tasks; the window has one row per bin of a group.
    """
    whole = Window.partitionBy(*by)
    filled = rows.groupBy(*by, F.expr(bin_of).alias("bin")).agg(F.count("*").alias("rows")).withColumns({
        "upto": F.sum("rows").over(whole.orderBy("bin")), "n": F.sum("rows").over(whole)})
    reached = filled.filter(F.col("upto") >= share * F.col("n")).groupBy(*by).agg(
        F.min("bin").alias("bin"), F.first("n").alias("n"))
    return reached.select(*by, "n", F.expr(edge_of).alias("cut"))


def covariance_determinant(rows: DataFrame, columns, floors, share: float = 0.75, steps: int = 3) -> DataFrame:
    """(grp, size, centre, inverse, scatter) per group: minimum-covariance-determinant centre and inverse scatter.

    `rows` has the column grp and the statistics, and should be a written table.
    Median and median deviation of each statistic start the search. Each
    concentration step takes the `share` of a group's rows with the smallest
    distance and sets centre and scatter from them, which never raises the
    determinant. All rows of all groups go through each step together; groups
    meet only in partial sums and bin counts, so a group of any size is no task
    of its own. Medians are found to 1/1024, the limit of a step to a fiftieth
    of its value. The scatter is scaled to a normal sample, and the squares of
    `floors` are added to its diagonal, so that a statistic that is constant in
    a group does not reject the first row that differs.
    """
    p = len(columns)
    limit = chi2_limit(share, p)
    scale = share / chi2_share(limit, p + 2)

    def medians(values: DataFrame, name: str) -> DataFrame:
        long = values.unpivot(["grp"], list(columns), "statistic", "value")
        cuts = _cut_points(long, 0.5, "bigint(floor(value * 1024))", "(bin + 0.5D) / 1024", ("grp", "statistic"))
        wide = ", ".join(f"max(if(statistic = '{c}', cut, null))" for c in columns)
        return write_and_reread(cuts.groupBy("grp").agg(
            F.first("n").alias("size"), F.expr(f"array({wide}) as middle")), name)

    centre = medians(rows.select("grp", *columns), "medians").withColumnRenamed("middle", "centre")
    off = [F.expr(f"abs({c} - centre[{i}])").alias(c) for i, c in enumerate(columns)]
    spread = medians(rows.join(centre, "grp").select("grp", *off), "spreads").drop("size")
    inverse = ", ".join(
        f"1 / (pow(1.4826D * middle[{i}], 2) + {float(floors[i]) ** 2!r}D)" if i == j else "0D"
        for i in range(p) for j in range(p))
    now = write_and_reread(
        centre.join(spread, "grp").select("grp", "size", "centre", F.expr(f"array({inverse}) as inverse")), "estimates")
    for _ in range(steps):
        far = rows.join(now, "grp").withColumn("far", F.expr(_distance(columns)))
        limits = _cut_points(far, share, "bigint(floor(ln(greatest(far, 1e-12D)) * 50))", "exp((bin + 1) / 50D)")
        inside = far.join(write_and_reread(limits.select("grp", "cut"), "limits"), "grp").filter("far <= cut")
        first = ", ".join(f"sum({c})" for c in columns)
        second = ", ".join(f"sum({a} * {b})" for a in columns for b in columns)
        sums = inside.groupBy("grp").agg(
            F.first("size").alias("size"), F.count("*").alias("inside"),
            F.expr(f"array({first}) as first"), F.expr(f"array({second}) as second"))
        now = write_and_reread(_estimates(sums, columns, floors, scale), "estimates")
    return now


def _marked(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """Rows with `counts`, and with base_failed and the three groups they may be judged by."""
    level = lambda n, *of: F.to_json(F.struct(F.lit(n).alias("level"), *of))
    return counted.withColumns({
        "base_failed": F.expr("counts.n_words < 10 or 100 * counts.n_repeat_words > 20 * counts.n_words"),
        "__groups": F.array(level(2, F.col(lang).alias("lang"), F.col(source).alias("source")),
                            level(1, F.col(lang).alias("lang")), level(0))})


def _drawn_to(own: DataFrame, above: DataFrame, weight: float) -> DataFrame:
    """Centre and scatter of each group drawn towards those of the group above it, which counts as `weight` rows."""
    def drawn(mine, theirs):
        return f"zip_with({mine}, {theirs}, (a, b) -> (size * a + {weight}D * b) / (size + {weight}D))"

    parents = above.select(F.col("grp").alias("parent"), F.col("centre").alias("__c"), F.col("scatter").alias("__s"))
    return own.join(parents, "parent").select(
        "grp", "size", F.expr(drawn("centre", "__c")).alias("centre"), F.expr(drawn("scatter", "__s")).alias("scatter"))


def _inverted(found: DataFrame, floors) -> DataFrame:
    """(grp, size, centre, inverse) of the scatter with the squares of the floors on its diagonal."""
    p, floor = len(floors), np.diag(np.square(np.array(floors, float)))

    def run(batches):
        for pdf in batches:
            cov = np.array(pdf["scatter"].tolist(), float).reshape(-1, p, p) + floor
            pdf["inverse"] = list(np.linalg.inv(cov).reshape(len(pdf), p * p)) if len(pdf) else []
            yield pdf[["grp", "size", "centre", "inverse"]]

    return found.mapInPandas(run, "grp string, size long, centre array<double>, inverse array<double>")


def fit(counted: DataFrame, lang: str = "lang", source: str = "source", floors=FLOORS, share: float = 0.75,
        least: float = 100, steps: int = 3, prior=PRIOR) -> DataFrame:
    """(grp, size, centre, inverse, rates) of every language and source, of every language (with its rates), and of the whole.

    Estimates come from all rows that pass the plain limits; NULL is a language
    and a source of its own. There is no size from which on a group counts: its
    centre and scatter are drawn towards its language's, a language's towards
    the whole's, and the whole's scatter towards `prior`, where what is above
    has the weight of `least` rows.

    The floors matter where nearly all rows of a group have the same value, as
    with symbols and repeats; word length, distinct words and marks vary by more
    than theirs, and are judged by the estimated scatter with its correlations.
    At the default limit of `verdicts` (a distance of 6.2) each statistic can
    still reject alone.
    """
    passed = _marked(counted, lang, source).filter(~F.col("base_failed")).select("counts", "__groups")
    rates = write_and_reread(_rates(passed), "rates")
    placed = passed.join(rates, F.col("__groups")[1] == rates["grp"])
    rows = write_and_reread(placed.select("__groups", *[v.alias(k) for k, v in statistics("rates").items()]), "statistics")
    found = write_and_reread(covariance_determinant(
        rows.select(F.explode("__groups").alias("grp"), *STATISTICS), STATISTICS, floors, share, steps), "found")
    above = rows.select(F.explode(F.expr("array(struct(__groups[0] as grp, __groups[1] as parent, 2 as level), "
                                         "struct(__groups[1] as grp, __groups[2] as parent, 1 as level))")).alias("g")).select("g.*").distinct()
    placed = write_and_reread(found.join(above, "grp", "left").select("grp", "parent", "level", "size", "centre", "scatter"), "placed")
    p = len(STATISTICS)
    believed = "array(" + ", ".join(f"{float(prior[i]) ** 2 if i == j else 0.0!r}D" for i in range(p) for j in range(p)) + ")"
    whole = placed.filter("level is null").select(
        "grp", "size", "centre",
        F.expr(f"zip_with(scatter, {believed}, (a, b) -> (size * a + {float(least)}D * b) / (size + {float(least)}D))").alias("scatter"))
    languages = _drawn_to(placed.filter("level = 1"), whole, float(least))
    sources = _drawn_to(placed.filter("level = 2"), languages, float(least))
    inverted = _inverted(whole.unionByName(languages).unionByName(sources), floors)
    return write_and_reread(inverted.join(rates, "grp", "left"), "fitted")


def verdicts(counted: DataFrame, fitted: DataFrame, lang: str = "lang", source: str = "source",
             reject: float = 1e-6) -> DataFrame:
    """Add base_failed, distance and kept to rows with `counts`.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated
    windows. kept: not base_failed, and the squared Mahalanobis distance from
    the centre of the row's language and source is no more than a normal row
    exceeds with probability `reject`. A row whose language and source was not
    among the fitted ones is judged by its language, else by the whole; where
    nothing was fitted no row is rejected by distance. Repeated rows get one
    verdict each; an empty table gives an empty one.
    """
    out = _marked(counted, lang, source)
    for i in range(3):
        out = out.withColumn(f"__g{i}", F.col("__groups")[i]).join(
            fitted.select(F.col("grp").alias(f"__g{i}"), F.struct("centre", "inverse", "rates").alias(f"__fit{i}")), f"__g{i}", "left")
    usual = F.struct(*[F.lit(v).alias(k) for k, v in USUAL.items()])
    out = out.withColumns({"__fit": F.coalesce("__fit0", "__fit1", "__fit2"), "__rates": F.coalesce("__fit1.rates", usual)})
    out = out.withColumn("__stats", F.struct(*[v.alias(k) for k, v in statistics("__rates").items()]))
    terms = _distance([f"__stats.{c}" for c in STATISTICS]).replace("centre[", "__fit.centre[").replace("inverse[", "__fit.inverse[")
    near = F.coalesce(F.col("distance") <= chi2_limit(1 - reject, len(STATISTICS)), F.lit(True))
    return (
        out.withColumn("distance", F.expr(terms)).withColumn("kept", ~F.col("base_failed") & near)
        .drop("__stats", "__rates", "__groups", "__fit", *[f"__fit{i}" for i in range(3)], *[f"__g{i}" for i in range(3)])
    )


def judge(counted: DataFrame, lang: str = "lang", source: str = "source", reject: float = 1e-6, **how) -> DataFrame:
    """`verdicts` on the rows that were fitted, which should be a written table."""
    return verdicts(counted, fit(counted, lang, source, **how), lang, source, reject)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", reject: float = 1e-6,
              **how) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns.

    Texts are counted twice, once to fit and once to judge, as a table of all
    texts with their counts would cost as much disk as the corpus.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[lang].alias("lang"),
                        docs[source].alias("source"), docs[text].alias("text"))
    counted = write_and_reread(with_counts(whole.select("lang", "source", "text")).drop("text"), "counted")
    fitted = fit(counted, **how)
    return verdicts(with_counts(whole).drop("text"), fitted, reject=reject).filter("kept").select("doc.*")
