import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from temperament.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, **{"spark.checkpoint.dir": folder, "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression on a single row of the given values."""

    def evaluate(expression, **values):
        schema = ", ".join(f"{name} {kind}" for name, (_, kind) in values.items()) or "x int"
        row = tuple(value for value, _ in values.values()) or (1,)
        return spark.createDataFrame([row], schema).select(expression.alias("out")).first()["out"]

    return evaluate
