import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from wardline.session import build_session, release_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wardline-tests",
        "local[8]",
        8,
        {
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wardline-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture()
def fresh_dir():
    return tempfile.mkdtemp(prefix="wardline-test-")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
