import tempfile

import pytest

from moodlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder per test; nothing is cleared."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def frame(spark):
    """frame(["a", None]) -> one string column ``c`` in that order, plus ``n``."""

    def make(values, kind="string"):
        return spark.createDataFrame(list(enumerate(values)), f"n int, c {kind}")

    return make


@pytest.fixture
def evaluate(frame):
    """evaluate(column_function, values) -> the results in order."""

    def run(fn, values, kind="string"):
        rows = frame(values, kind).select("n", fn("c").alias("out")).collect()
        return [r.out for r in sorted(rows, key=lambda r: r.n)]

    return run
