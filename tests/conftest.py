import sys
from pathlib import Path

import pytest

root = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(root), str(root / "tests")]

from ebbtide.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return FOLDER
