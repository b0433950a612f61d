import pytest

from skygrid.session import tune
from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    return tune(session())
