from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import local_test_session

    session = local_test_session(cores="*", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def cached_rows_let_go():
    """The plans of other modules' tests would read the rows that a module's fixtures cache."""
    from pyspark.sql import SparkSession

    yield
    if session := SparkSession.getActiveSession():
        session.catalog.clearCache()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
