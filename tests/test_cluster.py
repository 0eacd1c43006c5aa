import pytest

from presswork import cluster


class Session:
    """A session without a shared folder."""

    def __init__(self, configured=None, master="local[2]"):
        self.configured, self.directory, self.master = configured, None, master
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.configured if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, path):
        self.directory = path


def test_the_configured_folder_is_used():
    session = Session("/shared/folder")
    assert cluster.shared_root(session) == "/shared/folder" and session.directory is None


def test_a_temporary_folder_only_without_one():
    session = Session()
    root = cluster.shared_root(session)
    assert root and cluster.shared_root(session) == root


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        cluster.shared_root(Session(master=master))


def test_paths_are_fresh(spark):
    paths = {cluster.shared_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all("/presswork/x-" in p for p in paths)


def test_materialized_rows_are_read_from_the_written_table(spark):
    out = cluster.materialize(spark.range(5))
    assert out.count() == 5 and out.inputFiles() and cluster.is_small(out, 5) and not cluster.is_small(out, 4)


def test_discarded_tables_are_gone(spark, tmp_path):
    kept, gone = cluster.materialize(spark.range(3)), cluster.materialize(spark.range(4))
    cluster.discard(gone, None, spark.range(2))
    assert kept.count() == 3
    with pytest.raises(Exception, match="FileNotFound|does not exist|not exist"):
        gone.count()
