import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pixloom.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("pixloom-tests", cores=8, spark__driver__memory="3g", spark__sql__shuffle__partitions="3")
    s.sparkContext.setLogLevel("ERROR")
    return s
