import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from keelson.session import local_session  # noqa: E402
from keelson.spec import house_spec  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spec():
    return house_spec(2026)
