"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import registry
from compare import database, differences

FOLDER = "/root/testdata/sf0.001"
registry.load_all()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

# too few rows to show anything at this scale
MAY_BE_EMPTY = {"J5_similar_lines", "J6_S13_missing_keys", "A14_unfinished_traits", "X4_difference", "S7_partitioned_tree"}


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, connection, name):
    problem = differences(registry.QUERIES[name](spark, FOLDER), connection, registry.ORACLES[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY), problem


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_has_rows(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).count() > 0
