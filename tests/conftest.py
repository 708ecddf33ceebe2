from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    return spark


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
