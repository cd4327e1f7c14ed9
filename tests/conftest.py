import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabloom.plans import release  # noqa: E402
from tabloom.session import local_session  # noqa: E402
from tools.check_queries import connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("OFF")
    yield session
    release()
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="session")
def small():
    return SMALL
