import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillbook.session import build_session
    scratch = tempfile.mkdtemp(prefix="tillbook-tests-")
    s = build_session("local[4]", app_name="tillbook-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillbook-run-")
