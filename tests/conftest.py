import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lossgrain.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    spark = session("tests", **{
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": shared,
        "spark.driver.memory": "4g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
