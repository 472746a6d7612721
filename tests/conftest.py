import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetlens.session import build_session
    scratch = tempfile.mkdtemp(prefix="fleetlens-tests-")
    s = build_session("local[*]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from fleetlens.plans.tables import CourierTables
    return CourierTables.from_testdata(spark, SF_SMALL)


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="fleetlens-run-")
