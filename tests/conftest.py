import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reviewlake.session import get_session

    base = tmp_path_factory.mktemp("spark")
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"file://{base}/shared",
        "spark.sql.warehouse.dir": f"{base}/warehouse",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
