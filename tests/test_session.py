import os

from driftline.session import release_scratch, scratch_path, scratch_root


def test_scratch_folders_are_per_application_and_can_be_released(spark):
    path = scratch_path(spark, "release-test")
    assert path.startswith(scratch_root(spark)) and spark.sparkContext.applicationId in path
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.exists(local)
    release_scratch(spark, path)
    assert not os.path.exists(local)
