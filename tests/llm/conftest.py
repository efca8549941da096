import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import prose  # noqa: E402

@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    a repeated id with another text, and columns named like internal ones."""
    long = prose(1, 250_000)  # over a million characters
    same = prose(2, 60)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, same, "en", "a"),
            (4, same, "en", "a"), (4, prose(3, 50), "fr", None), (None, same, "en", None), (5, long, "fr", "b"),
            (6, "?!", None, None), (7, "one two", "en", "b"), (8, "One  TWO", "fr", "b"), (None, None, None, None)]
    extra = "row n c id key label words h lines hits ids text_hash base found rank word x kept score sampled".split()
    rows = [r + tuple(f"{name}{k}" for name in extra) for k, r in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{x}` string" for x in extra)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("doc_id = -1")
