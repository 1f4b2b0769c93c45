import hashlib

import pytest
from pyspark.sql import functions as F

#: column names that operators use inside, as extra columns of the input
CLASHING = ("score", "labels", "n_words", "size", "batch", "row_key", "key", "block", "p", "stratum", "copies", "tokens", "__t", "__id")


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents with clashing extra columns from (doc_id, text[, source]) rows."""

    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])

    return make


@pytest.fixture(scope="session")
def word():
    """A made-up word per number."""
    return lambda n: "w" + hashlib.md5(str(n).encode()).hexdigest()[:6]
