import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkwork.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="sparkwork-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()
