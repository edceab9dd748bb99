import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from irspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", "8g")


@pytest.fixture
def tiny_limits(spark):
    """Every key counts as hot, nothing may be broadcast."""
    from checks.run import SPLIT

    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    yield
    for key in SPLIT:
        spark.conf.unset(key)
