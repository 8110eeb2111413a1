import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import checkpoint_dir, get_spark, release
    s = get_spark("local[*]", app="ledgerlake-tests", shuffle_partitions=8)
    checkpoint_dir(s)  # sets a private folder only when the session has none
    yield s
    release(s)
    s.stop()
