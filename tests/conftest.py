import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadastra.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def small_blocks(spark):
    """Text files cut into blocks of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)
