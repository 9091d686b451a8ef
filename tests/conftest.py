import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shedlake.session import local_session, scratch_dir  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    return local_session("shedlake-tests", cores=8)


@pytest.fixture
def scratch(spark):
    return scratch_dir(spark, "test")


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"
