"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans joins from runtime
# sizes (broadcast when a side turns out small, splits skewed partitions).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ionframe",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given (a cluster submit supplies its own).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    When it is unset and the session runs in local mode (tests, laptops) a
    fresh scratch folder is created and registered; on a cluster an unset
    value is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, GCS) before running iterative operators")
    path = tempfile.mkdtemp(prefix="ionframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Paths of stored tables that `scratch_tables` has yet to remove, in the order of their making.
_STORED: list[str] = []


@contextlib.contextmanager
def scratch_tables(spark: SparkSession):
    """Remove, at the end of the block, the tables that operators stored in it. Results are lazy and read these
    tables, so write them inside: ``with scratch_tables(spark): op(df).write.parquet(out)``."""
    before = set(_STORED)
    try:
        yield
    finally:
        drop_stored(spark, *[p for p in _STORED if p not in before])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, which `scratch_tables` removes."""
    _STORED.append(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _STORED[-1]


def materialize_at(df, name: str = "stage"):
    """Cut the lineage of ``df``: write it once as Parquet under the shared
    checkpoint folder and read it back (one job; the read side carries real
    size statistics for the planner). Survives the loss of executors, unlike
    a local checkpoint or a cache. Returns the table and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df, name: str = "stage"):
    """The table of `materialize_at`."""
    return materialize_at(df, name)[0]


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Remove tables of `materialize_at` that nothing reads any more."""
    for path in paths:
        if path in _STORED:
            _STORED.remove(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def reliable_checkpoint(df, name: str = "stage"):
    """Eager ``df.checkpoint()`` into ``spark.checkpoint.dir`` (shared
    storage on a cluster): cuts the lineage, survives executor loss, and
    keeps the plan's hash partitioning, so a loop joining on the same key does
    not re-shuffle the checkpointed side."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
