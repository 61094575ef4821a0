import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="4g", app="quire-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def docs_small(spark):
    from quire.sources.collection import read_corpus
    return read_corpus(spark, f"{SF0001}/documents.parquet").good


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
