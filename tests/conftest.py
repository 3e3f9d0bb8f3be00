from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from haulmark.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "haulmark-tests", "local[8]", spark_sql_shuffle_partitions=8, spark_ui_enabled="false",
        spark_driver_memory="8g", spark_checkpoint_dir=tmp_path_factory.mktemp("shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
