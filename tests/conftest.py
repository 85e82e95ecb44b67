import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path[:0] = [p for p in [ROOT] if p not in sys.path]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

from terrane.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(int(os.environ.get("TEST_CPUS", "8")), "terrane-tests", shuffle=8)
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()
