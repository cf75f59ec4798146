import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lavoura.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(
        "tests",
        8,
        f"{scratch}/checkpoint",
        **{"spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.driver.memory": "6g"},
    )
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path_factory):
    return str(Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")))
