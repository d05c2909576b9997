import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tiercraft.session import build_session  # noqa: E402
from tiercraft.sources.store import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def store(spark, tmp_path):
    tag = tmp_path.name.replace("-", "_")
    return Warehouse(spark, f"silver_{tag}", f"gold_{tag}", str(tmp_path))
