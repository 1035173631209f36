import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from almsbook.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("*", memory="4g", partitions=4, shared_dir=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables at {DATA}")
    return DATA
