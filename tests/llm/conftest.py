import pytest

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, token string, label int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, a very long one, one very long word, repeated rows, a null id, clashing column names."""
    texts = [
        (0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (5, "Alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (6, "word " * 60_000), (7, "x" * 150_000), (8, "é漢字 \u200b!! $$$ 12 <|endoftext|>"), (None, "no id here at all"), (9, "two words"),
    ]
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, "r", "t", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def empty(spark):
    return lambda df: df.filter(F.lit(False))
