import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from orchard.session import get_spark
    s = get_spark("local[*]", 8, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="orchard-wh-")})
    yield s
    s.stop()
