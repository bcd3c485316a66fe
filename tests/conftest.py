import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barline.session import build_session

    ckpt = tempfile.mkdtemp(prefix="barline-test-ckpt-")
    s = build_session(master="local[4]", app="barline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
