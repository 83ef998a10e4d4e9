import os

import pytest

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from quaystone.runtime import session, ship

    s = session("tests", 4, 4)
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
