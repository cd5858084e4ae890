import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import build_session, checkpoint_dir  # noqa: E402

NOW = 1700010000


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
