import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cargomart.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = local_session(cores="*", shuffle_partitions=8, warehouse=wh, app_name="cargomart-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
