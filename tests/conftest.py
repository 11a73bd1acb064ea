import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from newsflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder (local path)."""
    from newsflow.session import shared_path
    p = shared_path(spark, "tests", uuid.uuid4().hex[:8])
    local = p[len("file:"):] if p.startswith("file:") else p
    os.makedirs(local, exist_ok=True)
    return local
