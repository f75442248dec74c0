import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendlayer.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app="lendlayer-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lendlayer-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lendlayer-test-")


def rows(df, order_by=None):
    """Collected rows as plain tuples, sorted (None first) for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
