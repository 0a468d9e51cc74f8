import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from check_queries import session

    found = session(8)
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture(scope="session")
def plan_of():
    def show(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return show
