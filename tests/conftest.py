import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("SNAPLAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from snaplake.session import get_session
    s = get_session("local[8]", shuffle_partitions=4,
                    extra={"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def con(sf_dir):
    from snaplake.checks.compare import duck
    return duck(sf_dir)
