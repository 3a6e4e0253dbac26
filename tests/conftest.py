import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import get_session  # noqa: E402
from stratalake.sources.lake import Lake  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"), buckets=4)


@pytest.fixture
def batch_id():
    return lambda: f"b-{uuid.uuid4().hex[:6]}"


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
