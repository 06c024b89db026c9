from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import CLASHING, SCHEMA, prose  # noqa: E402
from tidemark.session import workers_import  # noqa: E402

@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    workers_import(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): NULLs, empty, blank, very long, repeated and ordinary rows."""
    rnd = random.Random(7)
    rows = [
        (None, prose(rnd, 40), "en", "a"), (None, None, None, None), (1, None, "en", "a"), (2, "", "en", None),
        (3, " \t\n\x0b\x0c\r ", None, "b"), (4, prose(rnd, 30_000), "fr", "b"), (5, "x" * 50_000, "fr", "b"),
        (6, "12 34 ## | 56", "en", "a"), (7, "one", "en", "c"), (7, "one", "en", "c"), (8, "É ß 日本 \U0001f600 <|endoftext|>", "de", "é"),
    ]
    for i in range(10, 60):
        rows.append((i, prose(rnd, rnd.randrange(5, 120)), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", None])))
    return rows + rows[12:20] + [(99, rows[30][1], "en", "a")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
