import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onblock.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests",
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"},
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
