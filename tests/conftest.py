import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.plans.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "4", spark__sql__shuffle__partitions="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def at():
    return lambda day: dt.datetime(2025, 1, 1) + dt.timedelta(days=day)
