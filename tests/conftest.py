import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wryspark.session import get_session
    # Uses spark.checkpoint.dir when configured, else a fresh local folder.
    s = get_session("local[4]", app="wryspark-tests", shuffle_partitions=4)
    yield s
    s.stop()
