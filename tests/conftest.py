import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cabflow.session import get_session
    s = get_session(master="local[8]", app="cabflow-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "6g"})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="cabflow-test-")
