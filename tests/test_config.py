"""Scratch space comes from the cluster's shared checkpoint folder."""

from crashlake.config import scratch_path, shared_dir, staging_path


def test_scratch_lives_in_the_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_dir(spark)
    if configured:
        assert root == configured.rstrip("/")  # the cluster's folder, never a local temp dir
    else:
        assert spark.sparkContext.getCheckpointDir()  # bare session: a folder was registered
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    assert staging_path(spark, "s3a://lake/one", "t") == staging_path(spark, "s3a://lake/one", "t")
    assert staging_path(spark, "s3a://lake/one", "t") != staging_path(spark, "s3a://lake/two", "t")
