import tempfile

import pytest

from cellstar.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cellstar-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
