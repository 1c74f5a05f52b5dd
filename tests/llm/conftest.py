import datetime

import pytest

# Texts that operators must take without harm: null, empty, blank, very long, odd letters.
ODD = [
    (1, None, "a", "en"),
    (2, "", "a", None),
    (3, "   \n", None, "en"),
    (4, "one two three", "b", "en"),
    (5, "one two three", "b", "en"),
    (5, "one two three", "b", "en"),
    (None, "İstanbul ß Σίσυφος é \U0001f600 x", "c", "tr"),
    (7, "word " * 30_000, "c", "en"),
    (8, "tab\there  two\n\n\nlines <|endoftext|> 's 12", "a", "en"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, repeated rows, a very long text and extra columns that clash."""
    rows = [(*r, len(r[1] or ""), datetime.date(2024, 1, 1), "kept", 1.0, True) for r in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, source string, lang string, n_chars long, "
        "shard date, secrets string, severity double, toxic boolean",
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
