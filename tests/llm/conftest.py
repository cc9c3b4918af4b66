import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]

from helpers import DOCS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from cohortframe.session import get_session
    return get_session(master="local[4]", shuffle_partitions=6)


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) tuples."""
    def docs(rows, schema=DOCS):
        if schema == DOCS:
            rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(rows, schema)
    return docs

