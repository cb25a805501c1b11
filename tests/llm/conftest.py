import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang]) rows, over several partitions."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3, F.xxhash64("doc_id", "text"))
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "word " * 30_000), (5, "a" * 200_000), (6, "same text here"),
            (7, "same text here"), (6, "same text here"), (None, "no id at all"), (None, None), (8, "日本語 ▁ \U0001f600 \x00 é")]
