import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s0")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two three"), (4, "one two three"), (5, "one  two\tthree"),
        (None, "one two three"), (6, "word " * 60_000), (7, "é ß 漢字 \x00   🙂"), (8, "a b c", None, None), (9, "!!! 123"),
    ]
    return docs(rows).withColumns({c: F.lit("x") for c in ("node", "fp", "digest", "kept", "copies", "size", "component_id", "words")})
