import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagemart.session import build_session


@pytest.fixture(scope="session")
def checkpoint_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("checkpoints"))


@pytest.fixture(scope="session")
def spark(checkpoint_dir):
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.checkpoint.dir": checkpoint_dir},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions on literals."""

    def evaluate(*columns):
        row = spark.range(1).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return evaluate
