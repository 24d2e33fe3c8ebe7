from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hand import HAND_CSV  # noqa: E402
from skyledger.session import build_session, release_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def hand_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("hand") / "hand.csv"
    path.write_text(HAND_CSV)
    return str(path)
