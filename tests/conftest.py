import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from parcelle.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="parcelle-tests")
    yield session


@pytest.fixture(autouse=True)
def release_cached_frames(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="parcelle-test-")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
