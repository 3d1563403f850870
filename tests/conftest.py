import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))
DATA = os.environ.get("CAIRNLAKE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from cairnlake.session import build_session

    return build_session(cpus=8, memory="6g", app="tests")


@pytest.fixture(scope="session")
def data():
    if not Path(DATA, "sf0.001").exists():
        pytest.skip("no test tables")
    return DATA
