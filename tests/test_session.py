import pytest

from ferry.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 2**40, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 << 20))
    small = scale_conf(1 << 20, 64)
    assert small["spark.sql.shuffle.partitions"] == "128"          # at least twice the cores
    assert int(conf["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 1 << 30


def test_scratch_below_checkpoint_root(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/")) and a != b


def test_no_private_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
