"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods above this size; wide projections then run interpreted.
    # With the limit they are generated as many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the call site of every column expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Whether the shuffle files of a job are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How tables of numbers are compressed: a fifth smaller than by default.
CODEC = "zstd"

_local_folder: str | None = None


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create or get a session. On a cluster leave ``master`` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder; a cluster without one
    is a configuration error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix=f"barloom-{os.getpid()}-")
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through storage that survives the loss of executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage through a compressed table in the shared folder, for what several jobs read.

    Unlike :func:`checkpoint` readers take only the columns and rows they need; how the rows
    were dealt and ordered is not kept.
    """
    path = scratch_path(df.sparkSession, "stored")
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs of tables made inside delete their shuffle files when they end.

    Otherwise these stay until the driver collects garbage, which may be never: the disk then holds
    the shuffles of all steps at once.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def unstore(df: DataFrame) -> None:
    """Delete the table that :func:`stored` returned, when the last job has read it."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("stored-"):  # no other table that stands in for it
            remove(df.sparkSession, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by key into ``spark.sql.shuffle.partitions`` parts.

    For work that is heavy per byte: partitions are otherwise merged by size at run time,
    which would leave such work to a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
