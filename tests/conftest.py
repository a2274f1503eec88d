import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from nestfold.session import builder

    s = builder("local[*]", shuffle_partitions=8, app="nestfold-tests").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the session's checkpoint folder."""
    from nestfold.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture()
def localdir():
    """A fresh local folder for hand-written fixture files."""
    return tempfile.mkdtemp(prefix="nestfold-test-")
