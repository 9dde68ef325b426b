"""Shared Spark session for the test suite (local, 8 shuffle partitions, UTC, ANSI on)."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from rentyield.session import build_session
    warehouse = tempfile.mkdtemp(prefix="rentyield-warehouse-", dir="/tmp")
    s = build_session("local[*]", 8, extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
