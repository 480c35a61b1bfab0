import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from souk.session import local_session

    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    from souk.catalog import Shop

    return Shop(spark, SF)
