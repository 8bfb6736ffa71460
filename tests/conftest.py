from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from starhouse.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def staged(spark):
    """Staging tables by name, with the planted rows of tests/planted.py."""
    from planted import frames

    tables = frames(spark)
    return tables.__getitem__


@pytest.fixture(scope="session")
def wh(spark, staged):
    from starhouse import HEALTH
    from starhouse.plans.warehouse import DerivedWarehouse

    return DerivedWarehouse(spark, HEALTH, staged)
