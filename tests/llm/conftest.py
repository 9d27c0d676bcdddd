import pytest
from pyspark.sql import Row

LONG = " ".join(f"word{i} tail{i % 97}" for i in range(30_000))
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, label int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, columns with clashing names."""
    texts = [
        None, "", "   ", "\n\n", "one", "one two three", "a b c d e", LONG, LONG + " end", "x\ny\nz\nx\ny\nz\n",
        "MIT License and more\n\nApache  License", "tab\there\x0bthere", "<|endoftext|> in a text", "été 日本 \U0001f389",
        "same same same same same same same same same same same same same same same same same same same same same",
    ]
    rows = [(i, t, "en", "s", len(t) if t else None, "clash", "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "a b c d e", None, None, None, None, None, None), (100, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([Row(doc_id=i, quality=i % 2, toxic=0) for i in range(60)])
