import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dockwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[*]", shuffle_partitions=8, app_name="dockwise-tests")
    if not s.conf.get("spark.checkpoint.dir", None):  # tests set their own only where it is unset
        s.stop()
        extra = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
        s = build_session("local[*]", shuffle_partitions=8, app_name="dockwise-tests", extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
