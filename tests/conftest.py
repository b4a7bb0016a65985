import os
import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from climagrid.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    folder = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
    if not Path(folder).exists():
        pytest.skip("no test tables")
    return folder


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
