import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from patronage.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cpus=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
