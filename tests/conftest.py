import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()
