from types import SimpleNamespace

import pytest

from tripgrain.durable import checkpoint_dir, cut_lineage, scratch_path


def session(master, named=None, current=None):
    """Just enough of a session to choose a folder."""
    chosen = [current]
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: chosen[-1],
        setCheckpointDir=chosen.append,
    )
    conf = SimpleNamespace(get=lambda name, default: named or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    spark = session("yarn", named="hdfs:///shared")
    assert checkpoint_dir(spark) == "hdfs:///shared"
    assert spark.sparkContext.getCheckpointDir() == "hdfs:///shared"


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(session("yarn"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(session("local-cluster[2,1,1024]"))
    assert checkpoint_dir(session("yarn", current="hdfs:///set")) == "hdfs:///set"


def test_scratch_and_checkpoints_share_a_folder():
    spark = session("yarn", named="hdfs:///named", current="hdfs:///set")
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir() == "hdfs:///set"


def test_local_mode_makes_its_own():
    spark = session("local[2]")
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_scratch_paths_are_fresh_and_below_the_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(checkpoint_dir(spark))


def test_cut_lineage_reads_from_storage(spark):
    stored = cut_lineage(spark.range(10).groupBy().sum("id"))
    assert stored.first()[0] == 45
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
