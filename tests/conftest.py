import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(cpus="*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_root():
    # a fresh scratch folder per test (local tests only; jobs take a shared root)
    return tempfile.mkdtemp(prefix="tidemark-test-")
