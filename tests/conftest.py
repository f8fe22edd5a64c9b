import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dialtone.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="dialtone-test-ckpt-")
    s = build_session("local[4]", 4, app_name="dialtone-tests",
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted tuples (None-safe ordering)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
