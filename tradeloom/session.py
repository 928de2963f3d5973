"""Session defaults and the shared scratch folder."""

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


PARTITION_BYTES = 128 * 1024 * 1024
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_partitions(input_bytes):
    """Partitions that keep about 128 MB of shuffled rows each; adaptive execution merges small ones."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(app_name="tradeloom", master=None, input_bytes=None, **conf):
    """Session with the settings the package relies on: ANSI, UTC, adaptive execution.

    Give `input_bytes` for large inputs: 100 TB make about 800,000 shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if input_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    A session without that setting uses its warehouse. On a cluster that must be a shared store too:
    a warehouse on local disks would scatter stored tables over the executors, so that is an error.
    The caller's session is left as it is.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not re.match(r"local(\[|$)", master) and re.match(r"(file:)?/", warehouse):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share; {warehouse} is local")
    return f"{warehouse}/_scratch"


def scratch_path(spark, name):
    """A fresh path below the shared folder; never reused, so a retry cannot see old files."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark):
    """Inside, the files of a query's own shuffles go as soon as it has ended; nothing may read them again.

    The session has its former setting for that afterwards.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df, name):
    """Write a frame below the shared folder and read it back, which cuts its lineage; see `discard`.

    The files of the write's own shuffles go as soon as it has ended, see `shuffles_dropped`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames):
    """Remove the files of frames that `stored` made, after their last reader has run."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def remove(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
