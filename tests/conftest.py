from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for path in (ROOT, ROOT / "tests"):
    if str(path) not in sys.path:
        sys.path.insert(0, str(path))

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from statuteloom.session import build_session

    session = build_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not SF.exists():
        pytest.skip("test tables are not here")
    return str(SF)
