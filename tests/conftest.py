import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import build_session

    scratch = tempfile.mkdtemp(prefix="reelhouse-test-")
    s = build_session("local[4]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder; a cluster names a shared one
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="reelhouse-case-")


def rows(df, order=None):
    cols = sorted(df.columns) if order is None else order
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
