import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stockyard.session import build_session
    ckpt = tempfile.mkdtemp(prefix="stockyard-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="stockyard-test-wh-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="stockyard-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh,
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of dicts, sorted for comparison."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[k] is None, d[k]) for k in order))
    return out
