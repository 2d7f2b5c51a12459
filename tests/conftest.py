import tempfile

import pytest

from tidemart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemart-tables-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
