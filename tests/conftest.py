import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tidemark-wh-")
    s = build_session(
        master="local[8]",
        app_name="tidemark-tests",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.memory": "4g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")


@pytest.fixture()
def fresh_db(spark):
    """A fresh database as the current one, so table names never collide between tests."""
    name = "t_" + next(tempfile._get_candidate_names()).lower().replace("-", "_")
    spark.sql(f"CREATE DATABASE {name}")
    spark.catalog.setCurrentDatabase(name)
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")
