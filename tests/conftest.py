import json
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from storepulse.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "storepulse-tests", master="local[8]", spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """JSON lines from dicts (or ready strings)."""
    def make(*records):
        rows = [(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records]
        return spark.createDataFrame(rows, "value string")
    return make


@pytest.fixture
def put(spark):
    """Append one file of JSON lines to a topic folder."""
    def write(folder, topic, *records):
        rows = [(r if isinstance(r, str) else json.dumps(r), topic) for r in records]
        (spark.createDataFrame(rows, "value string, topic string").coalesce(1)
         .write.mode("append").partitionBy("topic").text(str(folder)))
    return write
