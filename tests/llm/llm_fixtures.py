"""Fixtures and paths shared by the tests of this folder."""

import pytest

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It's fine, isn't it?"),
    (2, "The quick brown fox jumps over the lazy dog. It's fine, isn't it?"),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, "Été à la plage <|endoftext|> <|STARTOFTEXT|> x² ½ 日本語 İstanbul ΣΑΣ 😀"),
    (7, "ein sehr langes wort " + "x" * 5000 + " und " + "wort " * 4000),
    (8, "\x1ca\x85b\xa0c  d \n\n e"),
    (None, "A row without an id"),
    (9, "repeated row"),
    (9, "repeated row"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeats, and columns with clashing names."""
    rows = [(i, t, "en", "ids", "group", 0, 1) for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, ids string, `group` string, row int, n int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
