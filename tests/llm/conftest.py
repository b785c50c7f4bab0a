import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table from (doc_id, text) or (doc_id, text, source) rows, with columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, DOC_SCHEMA)
        for c in ("fp", "score", "size", "n_tokens", "component_id", "row", "block", "digest", "words", "id"):
            df = df.withColumn(c, F.lit("clash"))
        return df
    return make
