import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from palimpsest.session import build_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = ship(build_session("tests", cpus=8, shuffle_partitions=4))
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
