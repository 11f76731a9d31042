import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Columns that operators name too come along, to be ignored or kept.
NAMES = ("fp", "k", "component_id", "lang_pred", "n_tokens", "weight", "u")


@pytest.fixture(scope="session")
def docs_schema():
    own = (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))
    return T.StructType([T.StructField(n, t) for n, t in (*own, *[(n, T.StringType()) for n in NAMES])])


@pytest.fixture(scope="session")
def make_docs(spark, docs_schema):
    def make(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, None, None)[:4]
            full.append((doc, text, lang, source, None if text is None else len(text), *["clash"] * len(NAMES)))
        return spark.createDataFrame(full, docs_schema)

    return make


@pytest.fixture(scope="session")
def make_pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, digest string")

    return make
