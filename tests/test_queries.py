"""Every registered query beside its SQL on the smallest tables."""

import importlib.util
import os

import pytest

from cadastra.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "oracle_check.py")
)
oracle_check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oracle_check)


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    line = oracle_check.compare(spark, con, name, FOLDER)
    assert line.startswith("ok"), line


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
