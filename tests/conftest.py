from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlark.session import local_session

    return local_session()


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck

    return duck(SMALL)
