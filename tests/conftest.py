from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh scratch folder per test (pytest's tmp_path)."""
    return str(tmp_path)
