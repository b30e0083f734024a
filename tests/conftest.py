import pytest

from tests.oracle import duck, session

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def db():
    return duck(SF_DIR)
