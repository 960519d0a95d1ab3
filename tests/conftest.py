import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = os.environ.get("SOUK_TEST_SF_DIR", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("SOUK_ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from souk.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="souk-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
