from __future__ import annotations

import pathlib
import sys

import pytest

sys.path[:0] = [str(pathlib.Path(__file__).parents[1]), str(pathlib.Path(__file__).parent)]

from tidestream.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    settings = {
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(warehouse),
    }
    session = local_session(8, "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"
