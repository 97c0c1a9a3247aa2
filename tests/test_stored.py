"""Tables that operators store go when the result is written."""

from pyspark.sql import functions as F

from ionframe import session
from ionframe.operators import inference, ordered


def _left(spark) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(session.checkpoint_dir(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(fs.listStatus(path)) if fs.exists(path) else 0


def test_nothing_is_left_after_the_block(spark, tmpdir_path):
    df = spark.range(200).select((F.col("id") % 40).alias("peptide"), (F.col("id") % 7).alias("protein"))
    kept = session.materialize(df, "kept")
    before = _left(spark)
    with session.scratch_tables(spark):
        inference.greedy_cover(df).write.parquet(f"{tmpdir_path}/a")
        ordered.row_number(kept, "peptide", ["protein"]).write.parquet(f"{tmpdir_path}/b")
        assert _left(spark) > before
    assert _left(spark) == before and kept.count() == 200
    assert spark.read.parquet(f"{tmpdir_path}/a").count() == 40
