import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8,2]",  # a failed task is tried once more
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file:{tmp_path_factory.mktemp('shared')}",
            "spark.sql.warehouse.dir": f"file:{tmp_path_factory.mktemp('warehouse')}",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return f"file:{tmp_path}/lake"


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")
