import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from baobab.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("baobab-tests", master="local[*]", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="baobab-wh-"),
                            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="baobab-ckpt-")})
    yield s
    s.stop()
