import os
import tempfile

import pytest

from ledgerweb.functions.lineage import clear_scratch
from ledgerweb.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checkpoint-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
