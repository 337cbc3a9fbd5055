import pytest

#: ids, texts, languages and sources with nulls, blanks, ties, repeated rows and a very long text
WORDS = "the river runs under old stone bridges while quiet boats drift past green fields and sleeping villages near mill".split()


def prose(n, start=0):
    return " ".join(WORDS[(start + i * (1 + i // 19)) % len(WORDS)] + str((start + i) % 7 or "") for i in range(n))


LONG = prose(30_000, 3)
DOCUMENTS = [
    (1, "A short text.", "en", "a", 13),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n\x0b ", "de", None, 5),
    (None, prose(80), "en", "b", 1),
    (5, LONG, "en", "b", len(LONG)),
    (6, prose(80, 9), "en", "a", 2),
    (6, prose(80, 9), "en", "a", 2),
    (7, prose(80, 9), "fr", "c", 2),
    (8, "Ünïcode ▁ and 日本語 😀 licence\nMIT License password = hunter2secret\n" + prose(60, 5), None, "c", None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows, with further columns named like what operators add."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(DOCUMENTS, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit(c) for c in ("row", "size", "ids", "digest", "_w", "_text", "kept", "bucket", "token", "score")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
