import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry_spark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SHUFFLE_PARTITIONS", "4")
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tests", 8, checkpoint_dir=str(shared), warehouse=str(shared / "warehouse"))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows of a small table from tuples and a schema string."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def values(spark):
    """Result of an expression over a one-column text table, in order."""

    def run(inputs, build):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string").coalesce(1)
        return [r[0] for r in df.orderBy("i").select(build(F.col("c"))).collect()]

    return run
