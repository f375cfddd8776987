import pytest

from crossfeed import connections, fixtures
from crossfeed.errors import ExternalError
from crossfeed.operators import checkpoints

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def on_a_cluster(monkeypatch):
    monkeypatch.setattr(fixtures, "is_local", lambda spark: False)
    monkeypatch.setattr(checkpoints, "is_local", lambda spark: False)
    monkeypatch.setattr(fixtures, "_folders", {})
    monkeypatch.setattr(fixtures, "_staged", {})
    monkeypatch.setattr(connections, "_registry", {})


def test_a_cluster_uses_the_folder_it_names(spark, on_a_cluster, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "shared_folder", lambda session: f"file://{tmp_path}")
    name = fixtures.source(spark, SF_DIR, "region", "lineitem")
    found = connections.resolve(name)
    assert found.kind == "dbapi" and found.target.startswith(str(tmp_path))
    cuts = fixtures.balanced_cuts(spark, SF_DIR, "lineitem", 3)
    assert len(cuts) >= 3


def test_a_folder_that_is_not_mounted_is_refused(spark, on_a_cluster, monkeypatch):
    monkeypatch.setattr(fixtures, "shared_folder", lambda session: "hdfs://name/checkpoints")
    with pytest.raises(ExternalError, match="spark.crossfeed.fixture.url"):
        fixtures.source(spark, SF_DIR, "region")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ExternalError, match="Set spark.checkpoint.dir"):
        checkpoints.shared_folder(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    assert not checkpoints.is_local(Session)
    Session.sparkContext.master = "local[4,2]"
    assert checkpoints.is_local(Session)


def test_an_own_database_is_used_where_one_is_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(connections, "_registry", {})
    monkeypatch.setattr(fixtures, "_staged", {})
    spark.conf.set(fixtures.URL_SETTING, f"dbapi:sqlite3:{tmp_path}/own.db")
    try:
        name = fixtures.source(spark, SF_DIR, "customer_nation")
        assert connections.resolve(name).target == f"{tmp_path}/own.db"
        # A later session finds the tables there and fills them again.
        monkeypatch.setattr(fixtures, "_staged", {})
        fixtures.source(spark, SF_DIR, "customer_nation")
    finally:
        spark.conf.unset(fixtures.URL_SETTING)
