import os

import pytest

from compare import database, differences
from temperament.llm import ORACLES, QUERIES, load_all

FOLDER = "/root/testdata/sf0.001"
load_all()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), database(FOLDER), ORACLES[name]) in (None, "no rows")
