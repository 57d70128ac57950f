import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gleanery.session import prepare  # noqa: E402
from workload.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    return prepare(session)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="gleanery-test-")


def png(width=3, height=2, tail=b""):
    return (
        b"\x89PNG\r\n\x1a\n\0\0\0\x0dIHDR" + width.to_bytes(4, "big") + height.to_bytes(4, "big") + b"\x08\x02\0\0\0" + tail
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
