import pytest

from quarry.session import ensure_checkpoint_dir, local_dir, materialize_frame, scratch_dir
from helpers import plan_text


def test_checkpoint_dir_is_kept(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()
    assert scratch_dir(spark, "x").startswith(first.rstrip("/") + "/x-")


def test_local_dir():
    assert local_dir("/a/b") == "/a/b"
    assert local_dir("file:/a/b") == "/a/b"
    assert local_dir("file:///a/b") == "/a/b"
    with pytest.raises(ValueError):
        local_dir("s3a://bucket/x")


def test_materialize_parquet_and_checkpoint(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    landed = materialize_frame(df, "t")
    assert sorted(landed.collect()) == sorted(df.collect())
    assert "parquet" in plan_text(landed).lower()
    intervals = spark.range(3).selectExpr("id", "make_interval(0, 0, 0, 0, 0, 0, id) AS i")
    kept = materialize_frame(intervals, "t2")  # intervals cannot go to Parquet: checkpoint()
    assert kept.count() == 3


def test_checkpoint_dir_needs_a_shared_folder_on_a_cluster():
    from quarry.session import _local_checkpoint_dir

    assert _local_checkpoint_dir("local[4]")
    assert _local_checkpoint_dir("local")
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError):
            _local_checkpoint_dir(master)


def test_local_dir_refuses_schemes():
    assert local_dir("file:/a/b") == "/a/b"
    assert local_dir("/a/b") == "/a/b"
    for path in ("hdfs:/x/y", "s3a://b/x"):
        with pytest.raises(ValueError):
            local_dir(path)
