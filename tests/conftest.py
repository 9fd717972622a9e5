import pytest

from strataflow.functions import session


@pytest.fixture(scope="session")
def spark():
    found = session.local("tests", cpus=4, partitions=4)
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
