import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tillsight.session import builder  # noqa: E402
from tillsight.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        builder(
            "tillsight-tests",
            **{
                "spark.sql.shuffle.partitions": "2",
                "spark.checkpoint.dir": str(shared),
                "spark.driver.memory": "6g",
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
            },
        )
        .master("local[4]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    return Workspace(spark)
