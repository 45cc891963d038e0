from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campaignlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # the checkpoint root comes from spark.checkpoint.dir; where that is unset
    # (a bare test machine) checkpoint_root() makes a private one
    s = build_session("local[*]", app_name="campaignlake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from campaignlake.session import scratch_path

    return scratch_path(spark, "tests", unique=True)
