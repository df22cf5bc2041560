import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tapeloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staged")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    from tapeloom.plans.compare import duck

    return duck(SF)
