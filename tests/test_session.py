from tidewater.session import STREAMING_CONF, checkpoint_root, scratch_path


def test_checkpoint_root_from_session(spark):
    root = checkpoint_root(spark)
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        assert root == conf.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_clear_scratch_removes_this_applications_paths(spark):
    import os

    from tidewater.session import clear_scratch, local_dir

    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.sparkContext.applicationId in path and os.path.isdir(local_dir(path))
    clear_scratch(spark)
    assert not os.path.exists(local_dir(path))
    clear_scratch(spark)  # nothing there is no error


def test_maintenance_interval_has_unit():
    assert STREAMING_CONF["spark.sql.streaming.stateStore.maintenanceInterval"].endswith("s")


def test_build_session_reuses_active_session(spark):
    from tidewater.session import build_session

    session = build_session("x", shuffle_partitions=8)
    assert session.sparkContext is spark.sparkContext
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.streaming.minBatchesToRetain") == "10"


def test_cluster_profile_keys():
    from tidewater.session import CLUSTER_CONF

    assert CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert int(CLUSTER_CONF["spark.sql.shuffle.partitions"]) >= 1000


def test_unknown_profile_rejected():
    import pytest

    from tidewater.session import build_session

    with pytest.raises(ValueError):
        build_session("x", profile="huge")


def test_submitted_settings_win(monkeypatch):
    """Every key of the profiles yields to a submitted one."""
    import tidewater.session as module

    submitted = {"spark.master": "local[1]", "spark.sql.adaptive.enabled": "false",
                 "spark.sql.streaming.minBatchesToRetain": "3", "spark.sql.shuffle.partitions": "17"}
    asked = {}

    class Conf:
        def contains(self, key):
            return key in submitted

    class Builder:
        def appName(self, name):
            return self

        def master(self, name):
            asked["spark.master"] = name
            return self

        def config(self, key, value):
            asked[key] = value
            return self

        def getOrCreate(self):
            return None

    monkeypatch.setattr(module, "SparkConf", Conf)
    monkeypatch.setattr(module.SparkSession, "builder", Builder())
    module.build_session("x", profile="cluster")
    assert not set(asked) & set(submitted)
    assert asked["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cluster_without_checkpoint_folder_is_refused():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_root(Session())
