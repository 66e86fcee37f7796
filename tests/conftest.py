import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from regua.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(checkpoints),
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    yield session
    session.stop()
