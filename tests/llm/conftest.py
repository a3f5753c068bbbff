import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents of (id, text) pairs, with the other columns filled."""

    def make(pairs, source="a"):
        rows = [(k, t, "en", source, len(t) if t is not None else None) for k, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture
def awkward(docs):
    """Nulls, empty and very long texts, repeated rows, and columns that clash with inner names."""
    from pyspark.sql import functions as F

    pairs = [
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, "one"),
        (5, "One"),
        (5, "One"),
        (None, "no id here, only words in a row"),
        (6, "x" * 300_000),
        (7, "word " * 60_000),
        (8, "ünïcödé 😀 text\x00with nul"),
    ]
    clashing = ("digest", "row", "_digest", "_kept_id", "_redacted", "_toxic", "node", "score",
                "token", "bin_id", "kept", "group", "host", "features", "text_sha256")
    df = docs(pairs)
    return df.withColumns({name: F.lit("mine") for name in clashing})
