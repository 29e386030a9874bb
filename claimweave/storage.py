"""Where intermediate data may live."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_stages: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder, which
    is removed when the process ends; on a cluster a folder of one machine would be
    lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="claimweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored rows.

    Later plans start from the files, whatever happens to the executors that
    wrote them. Unlike an RDD checkpoint this computes ``df`` once, and the
    files tell Spark their size, so joins with small results can broadcast.
    The files stay until drop_stages.
    """
    path = scratch_path(df.sparkSession, "stage")
    _stages.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Remove what cut_lineage has stored in this process; for the end of a job, when all results are written."""
    removed = 0
    while _stages:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stages.pop())
        removed += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return removed
