import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from segmint.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="segmint-tests")
    ensure_checkpoint_dir(s, fallback_local=True)
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="segmint-test-")
