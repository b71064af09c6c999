import os
import sys
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from brisa.session import build_session

    scratch = tempfile.mkdtemp(prefix="brisa-test-")
    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        app="brisa-tests",
        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"), "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
