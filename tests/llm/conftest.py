import random

import pytest

LONG = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split(), k=12_000))

#: Ids, texts and what is odd about them: nulls, empty and very long texts, repeated rows, ties.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while under the old tree."),
    (2, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while under the old tree."),
    (3, ""),
    (4, None),
    (5, " \t\n\x0b\x0c\r "),
    (6, LONG),
    (7, "a"),
    (8, "Ünïcödé täxt — mit Ümläuten, 漢字 und 😀."),
    (8, "Ünïcödé täxt — mit Ümläuten, 漢字 und 😀."),
    (None, "a row without an id has some words too"),
    (10, "x" * 5000),
    (11, "Line one\nLine one\n\nLine one\nLicensed under the MIT License.\n"),
]
#: Columns that share their names with what operators add or use inside.
CLASHING = ["n_words", "kept", "score", "key", "class_id", "n", "bucket", "block", "bytes", "lang_pred", "component_id", "_text", "n_tokens", "row", "place"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, text, None, "src", *("odd",) * len(CLASHING)) for i, text in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(row["doc_id"], row["text"]) for row in documents.select("doc_id", "text").collect()]
