import pytest

from meterproof.llm.queries import importable

PROSE = "the quick brown fox jumps over the lazy dog while seven grey geese watch from a quiet pond near the old mill"
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, id STRING, hash STRING, cls INT, n_words STRING, group STRING"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    clash = ("x", "y", 1, "z", "g")
    words = PROSE.split()
    long = " ".join(f"{words[i % len(words)]}{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "1234 --- !!", "en", "a"), (5, PROSE, "en", None),
        (6, PROSE, "en", "a"), (6, PROSE, "en", "a"), (7, long, "en", "b"), (8, "ein Satz über Bäume\nund\nnoch\nmehr", "de", "b"),
        (None, PROSE + " again", None, "b"), (None, None, None, None), (9, "line one\nline two\nline three\nline four", "en", "b"),
        (10, "zero\nline one\nline two\nline three\nend", "en", "b"), (11, "é" * 3000, "fr", "b"), (12, PROSE.upper() + ".", "en", "c"),
    ]
    return spark.createDataFrame([r + clash for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
