import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketframe.session import get_spark
    s = get_spark("local[4]", app="marketframe-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def model(spark):
    from marketframe.plans.model import Model
    return Model(spark, SF_SMALL)
