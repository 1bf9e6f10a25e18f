import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricelake.session import build_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="pricelake-tests-")
    session = build_session(
        "pricelake-tests",
        **{"spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/shared"},
    )
    yield session
    session.stop()
