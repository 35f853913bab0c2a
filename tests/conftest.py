import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import get_session

    s = get_session("local[4]", app="vigil-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="vigil-test-ck-")})
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF001
