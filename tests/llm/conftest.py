import pytest

LONG = "Alpha beta gamma delta epsilon. Zeta eta theta iota kappa lambda! " * 3000


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, repeated rows, equal texts and white space."""
    plain = "One two three four five six seven eight. Nine ten eleven twelve.\nThirteen fourteen fifteen."
    return [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, None, "en", None), (3, "", None, "b"), (4, " \n\t ", "fr", "b"), (5, LONG, "en", "a"),
        (6, plain, "en", "a"), (None, "no id here at all", "en", "a"), (None, None, None, None), (7, "x", "fr", "c"), (8, "naïve café ☃ 𝄞 ends", "fr", "c"),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows with columns whose names the operators use inside or return."""
    docs = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    clash = ("row", "n_email", "spans", "chunks", "hash", "node", "slot", "key", "removed", "units", "band", "size", "shard", "kept", "fingerprint", "n_words", "place", "h", "n_chars", "done", "x")
    return docs.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
