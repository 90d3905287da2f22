import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import local

    s = local(4, **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": "/tmp/quire-test-warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
