import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import local  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tests.compare import connect
    return connect(sf_dir)
