import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playmetrics.schema import RAW_SCHEMA  # noqa: E402
from playmetrics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="playmetrics-tests", shuffle_partitions=4,
                      extra_conf={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="playmetrics-test-")


@pytest.fixture()
def make_raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return make
