import pytest

from plenum.plans.tables import session


@pytest.fixture(scope="session")
def spark():
    made = session("tests", cores=8, partitions=4)
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
