"""One session for all tests."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

#: The smallest driver tables; tests that read them are skipped elsewhere.
TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    from commonweave.session import local_session

    session = local_session(4, "3g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
