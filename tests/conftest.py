import os
import sys
import tempfile

import pytest

os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]", app_name="tidemark-tests", shuffle_partitions=4,
        checkpoint_root=tempfile.mkdtemp(prefix="tidemark-test-ckpt-", dir="/tmp"),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp")


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
