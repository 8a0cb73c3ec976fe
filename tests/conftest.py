import tempfile

import pytest

from starloom.session import build_session


def make_session():
    return build_session(
        "starloom-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starloom-warehouse-"),
        },
    )


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
