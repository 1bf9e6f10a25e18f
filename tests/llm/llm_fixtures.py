"""Fixtures of the operators' tests; not a conftest, whose name the tests above use."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (id, text, source) as a documents table with columns that clash with names the operators use inside."""

    def make(rows):
        data = [(i, text, "en", source, None if text is None else len(text)) for i, text, source in rows]
        df = spark.createDataFrame(data, DOCS)
        extra = ("id", "size", "node", "key", "row", "line", "component", "bucket", "copies", "_node", "kept", "length")
        return df.withColumns({name: F.lit(f"other {name}") for name in extra})

    return make


@pytest.fixture(scope="session")
def scratch(spark):
    from pricelake.scratch import Scratch

    return lambda: Scratch(spark)
