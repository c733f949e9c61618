import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kwarta.config import Lake  # noqa: E402
from kwarta.plans import load  # noqa: E402
from kwarta.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lake(spark, tmp_path):
    tables = Lake(str(tmp_path / "lake"))
    load.create_tables(spark, tables)
    return tables
