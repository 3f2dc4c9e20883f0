"""Fixtures shared by the tests of this folder (imported by name)."""

import pytest

AWKWARD = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, None), (3, ""), (4, "   \n\t "), (5, "single"),
    (6, "one two three four five six seven eight nine ten eleven twelve"),
    (6, "one two three four five six seven eight nine ten eleven twelve"),  # a repeated row
    (None, "a document without an id"),
    (7, "\u00e9\u00e8 \u4f60\u597d \U0001f642 \u2028 x\u0000y " * 3),
    (8, "word " * 30000),  # very long, one repeated word
    (9, "a" * 50000),  # one very long word
    (10, "0123456789" * 3000),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns with clashing names."""
    rows = [(i, t, None, None, 0, "x", -1, []) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, "
                                       "n_words long, spans array<int>")


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_by_id(frame):
    """First column to the others; rows must have distinct ids."""
    rows = [tuple(r) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}
