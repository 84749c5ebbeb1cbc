import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfline.session import build_session
    s = build_session("local[4]", app="shelfline-tests", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false",
                             "spark.sql.streaming.schemaInference": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="shelfline-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


def rows(df, order=None):
    cols = order or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
