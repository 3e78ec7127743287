import os
import sys
import tempfile
import time

os.environ["TZ"] = "UTC"
time.tzset()

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripwise.session import build_session
    # spark.checkpoint.dir comes from the environment's defaults when set;
    # tripwise.session.shared_dir creates a scratch one only when it is unset
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle_compare import duck_connect
    return duck_connect(SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tripwise-test-")
