import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from feedlake.plans.session import session

    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.ui.showConsoleProgress": "false",
    }
    started = session("local[8]", "feedlake-tests", **settings)
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()
