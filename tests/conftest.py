import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "scripts"))

from tallymark.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests",
        "8",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tallymark-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
