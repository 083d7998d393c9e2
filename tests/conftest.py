import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from folioframe.session import local_session

    session = local_session("tests", 8, "6g", str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over a single row of named values."""

    def evaluate(expression, **values):
        from pyspark.sql import functions as F

        columns = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
        return spark.range(1).select(*columns).select(expression.alias("v")).first()["v"]

    return evaluate
