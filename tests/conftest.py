import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "scripts"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fundloom.session import local_session, remove_staged

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_staged()
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
