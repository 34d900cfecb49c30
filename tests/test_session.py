from types import SimpleNamespace

import pytest

from assaymill.session import materialise, setting, shared_folder, shared_root


class Session:
    """A session with settings of our choosing."""

    def __init__(self, master, configured=None, directory=None):
        self.conf = SimpleNamespace(get=lambda key, default: configured)
        self.sparkContext = SimpleNamespace(
            master=master, getCheckpointDir=lambda: directory, setCheckpointDir=self.chosen
        )
        self.directory = None

    def chosen(self, directory):
        self.directory = directory


def test_the_cluster_names_the_folder():
    session = Session("yarn", configured="hdfs://shared/checkpoints/")
    assert shared_root(session) == "hdfs://shared/checkpoints"
    assert session.directory == "hdfs://shared/checkpoints/"
    assert shared_root(Session("yarn", directory="hdfs://set/by/hand")) == "hdfs://set/by/hand"


def test_no_temporary_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session("spark://host:7077"))


def test_a_temporary_folder_on_a_local_master():
    session = Session("local[2]")
    assert shared_root(session) == session.directory


def test_folders_are_new(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_materialised_rows_have_no_lineage(spark):
    df = materialise(spark.range(10).selectExpr("id * 2 AS n"))
    assert df.count() == 10
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(RuntimeError), setting(spark, "spark.sql.ansi.enabled", "false"):
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
        raise RuntimeError
    assert spark.conf.get("spark.sql.ansi.enabled") == before
