import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tracklore.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, "tests", **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
