from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    scratch = tempfile.mkdtemp(prefix="quarry-test-")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        # spark.checkpoint.dir is left to the environment; the library only
        # picks a scratch folder when none is configured
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="quarry-case-")
