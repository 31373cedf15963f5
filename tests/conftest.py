import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the library too, wherever the tests are started
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from gridops.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="gridops-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` of a small test frame as a list of tuples, sorted."""
    out = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
