import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from warehaus.session import build_session, clean_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="warehaus-tests")
    yield s
    clean_scratch(s)
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from warehaus.session import scratch_path
    return scratch_path(spark, "tests")
