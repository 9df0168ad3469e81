import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rtml.session import get_spark  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[8]", spark__sql__shuffle__partitions="4",
                        spark__driver__memory="6g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def chunked(spark):
    """Force every ordered operator onto the chunked path."""
    spark.conf.set("rtml.chunk.minBytes", "0")
    yield
    spark.conf.unset("rtml.chunk.minBytes")


@pytest.fixture(scope="session")
def folder():
    return FOLDER
