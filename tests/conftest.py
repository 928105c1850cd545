import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from herdflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="herdflow-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples in input order."""
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
