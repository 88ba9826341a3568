import datetime

import pytest

from lullcast.schema import PanelSchema
from lullcast.session import local_session

START = datetime.date(2021, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "4g")
    yield session
    session.stop()


@pytest.fixture
def roles():
    return PanelSchema("ds", "y", ("id",))


@pytest.fixture
def panel(spark):
    """Make a panel from values per series, one day after the other."""

    def make(start=START, **series):
        rows = [
            (name, start + datetime.timedelta(days=i), None if y is None else float(y))
            for name, values in series.items()
            for i, y in enumerate(values)
        ]
        return spark.createDataFrame(rows, "id string, ds date, y double")

    return make
