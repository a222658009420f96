from __future__ import annotations

import os
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from ledgerloom.session import local_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_folder():
    return SMALL


@pytest.fixture(scope="session")
def tables(spark, small_folder):
    from ledgerloom.fixtures import Tables

    return Tables(spark, small_folder)
