import random

import pytest
from pyspark.sql import functions as F

from supplylens.llm.common import read
from tests.conftest import SMALL

#: Columns whose names the operators use inside; none may disturb them.
CLASHES = ["size", "target", "_p", "_b", "_k", "row", "block", "part", "key", "own", "label", "score", "lang_pred", "kept", "words"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


@pytest.fixture(scope="session")
def documents(spark):
    return read(spark, SMALL, "documents")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, near copies, clashing names."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    base = [word() for _ in range(120)]
    near = base[:60] + ["changed"] + base[61:]
    cut = base[:90]
    long = [word() for _ in range(9000)]
    texts = [
        (1, " ".join(base), "en", "a"),
        (2, "  ".join(near) + "\n", "en", "a"),
        (3, "\t".join(cut).upper(), "fr", None),
        (4, None, "en", "b"),
        (5, "", None, "b"),
        (6, " \n\t ", "de", "a"),
        (7, "1234 !!", "de", "c"),
        (8, " ".join(long), "de", "c"),
        (9, " ".join(long), None, "c"),
        (None, " ".join(base), "en", None),
        (10, "one two", "en", "a"),
        (11, "One  TWO", "en", "a"),
        (12, "one two three four five", "en", "a"),
        (13, " ".join(base[:40] * 3), "fr", "d"),
        (8, " ".join(long), "de", "c"),
        (14, "x", None, None),
        (14, "x", None, None),
        (15, "\U0001f600\u00a0é" * 5, "fr", "d"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    return clashing(df.withColumn("n_chars", F.char_length("text").cast("long"))).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
