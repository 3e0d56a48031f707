import pytest

from orderlens.session import local_session, work_path
from orderlens.sources.files import land
from tests.fixture_sheets import build


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sheets(spark):
    """The golden sheets, landed as Parquet."""
    return land(build(spark), work_path(spark, "golden"))


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Temporary views of one test are in no other's database listing."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for found in session.catalog.listTables():
            if found.isTemporary:
                session.catalog.dropTempView(found.name)
