import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tidemark-test-")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
