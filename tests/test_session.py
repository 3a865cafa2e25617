import pytest
from hearthline import configure, scratch_path, shared_dir


def test_the_named_shared_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(named) and first != second
    assert named.rsplit("/", 1)[-1] in spark.sparkContext.getCheckpointDir()


def test_configure_is_repeatable(spark):
    assert configure(configure(spark)) is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    # Only clusters get a larger number of initial shuffle partitions.
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_scratch_tables_are_released(spark, monkeypatch):
    from hearthline import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    path = session.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert session.release_scratch(spark) == 1
    assert session.release_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
