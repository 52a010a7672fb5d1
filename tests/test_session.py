import os

from tidemark import session


def test_shared_folder_is_the_configured_one(spark):
    folder = session.shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", None) or os.path.isdir(folder)
    first, second = session.scratch_path(spark, "a"), session.scratch_path(spark, "a")
    assert first != second and os.path.dirname(first) == folder


def test_checkpointed_rows_stay_the_same(spark):
    df = session.checkpointed(spark.range(100).selectExpr("id", "rand() AS r"))
    assert df.collect() == df.collect()
