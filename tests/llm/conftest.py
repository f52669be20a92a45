from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ("id", "t", "h", "k", "n", "kept", "fp", "ids", "rank", "part", "line", "word", "words", "_text", "_id", "kind", "attempt", "u", "e")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("the of and river stone light garden paper window table morning letter".split()) + str(rng.randrange(300)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(7)
    long = prose(rng, 30_000)
    base = prose(rng, 120)
    near = base.replace("the", "a", 1)
    rows = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n "), (7, long), (8, long), (8, long), (9, "one"), (10, "one two"),
        (None, base), (None, None), (11, "x" * 50_000), (12, "MIT License mit-license\nReleased under the MIT License."),
        (13, "Licensed under the Apache License, Version 2.0."), (14, "日本語 текст ñandú 🙂 emoji space"),
        (15, "a b c d e f\na b c d e f\na b c d e g\nb c d e f\n\n\na b"), (16, "Ask Mrs. Anna Smith or mr@x.org, +1 (499) 555-6503 / 1.2.3.4"),
    ]
    rows = [(i, x, "en" if k % 2 else None, "s" if k % 3 else None, None if x is None else len(x)) for k, (i, x) in enumerate(rows)]
    frame = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
