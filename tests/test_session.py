import pytest

from moodlake.session import SETTINGS, scratch_dir, scratch_table


class FakeContext:
    def __init__(self, master):
        self.master = master


class FakeSession:
    """Stands in for a session with a given master and checkpoint folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = FakeContext(master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_scratch_goes_below_the_shared_folder():
    path = scratch_dir(FakeSession("yarn", "hdfs:///shared/"), "x")
    assert path.startswith("hdfs:///shared/moodlake/x-")
    assert path != scratch_dir(FakeSession("yarn", "hdfs:///shared/"), "x")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("spark://host:7077"), "x")
    assert scratch_dir(FakeSession("local[4]"), "x").startswith("/")


def test_scratch_table_cuts_the_plan(spark):
    table = scratch_table(spark.range(10).selectExpr("id * 2 AS n"), "numbers")
    assert "Range" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.n for r in table.collect()) == list(range(0, 20, 2))


def test_settings(spark):
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
