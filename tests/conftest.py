import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import get_session

    warehouse = tempfile.mkdtemp(prefix="tripmart-wh-")
    session = get_session(
        "local[4]",
        app_name="tripmart-tests",
        shuffle_partitions=8,
        extra_conf={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tripmart-test-")
