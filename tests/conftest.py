import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbtide.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def inputs(spark):
    from ebbtide.registry.base import Inputs

    return Inputs.over(spark, SF)
