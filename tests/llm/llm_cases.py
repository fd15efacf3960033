import os
import re

import pytest

pytest.importorskip("lodgemart.llm")

SF = "/root/testdata/sf0.001"
CASE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ("id", "h", "c", "n", "k1", "row", "key", "start", "gone", "leak1", "block", "position", "words", "s", "rank")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return (text or "").translate(CASE)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables absent")
    return SF


@pytest.fixture(scope="session")
def texts(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    body = " ".join(f"w{i % 61}x{i % 7}" for i in range(120))
    return [
        (1, body, "en", "a", 5),
        (1, body, "en", "a", 5),
        (2, body, None, None, None),
        (3, None, "en", "a", 1),
        (4, "", "en", "b", 0),
        (5, "one two", "en", "b", 7),
        (6, "ONE two", "en", None, 7),
        (None, body, "en", "a", 5),
        (None, None, None, None, None),
        (7, body.replace("w3x3", "other", 1), "en", "b", 9),
        (8, " \n\t ", "xx", "b", 4),
        (9, "tail " * 20_000 + "end", "en", "a", 100_003),
        (5, "a second text of the same id", "en", "b", 7),
        (10, "été naïve 日本語 <|endoftext|> x's  y\n\nz", "fr", "b", 30),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with further columns whose names clash with those used inside."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(odd_rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
