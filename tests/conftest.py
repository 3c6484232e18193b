import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session
    session = build_session("tests", cores=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def retail(spark, folder):
    from cartwheel.sources.retail import Retail
    return Retail(spark, folder)


@pytest.fixture(scope="session")
def duck(folder):
    from parity import connect
    return connect(folder)
