import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from accountwise.config import Params  # noqa: E402
from accountwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", "accountwise-tests",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="6g",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def params():
    return Params(cutoff=date(2023, 1, 1), as_of=date(2024, 1, 1))
