from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="tallyspark-tests", shuffle_partitions=8,
                    conf={"spark.ui.enabled": "false"})
    sc = s.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tallyspark-test-")
