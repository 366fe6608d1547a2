import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidewatch import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
