from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from coverledger.session import tune  # noqa: E402
from tests.compare import duck, spark_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = tune(spark_session())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
