"""Versioned publishing: every load writes a new folder, nothing is moved or replaced.

``<root>/data/<ts>-<attempt>`` holds the rows of one attempt of a load, and
``<root>/commits/<ts>`` names the folder that counts for that time. The commit file is
written last, and created only if it does not exist: of two loads of one time one is
published and the other one fails. An attempt that died half way has no commit file,
is invisible and can be repeated; what is published never changes.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _stamp(at: dt.datetime | str) -> str:
    moment = dt.datetime.fromisoformat(at) if isinstance(at, str) else at
    return moment.strftime("%Y%m%d%H%M%S")


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema("snapshot_ts string, folder string").json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _is_published(spark: SparkSession, root: str, stamp: str) -> bool:
    commits = _commits(spark, root)
    return commits is not None and not commits.filter(F.col("snapshot_ts") == stamp).isEmpty()


def _commit(spark: SparkSession, path: str, content: dict[str, str], link: bool | None = None) -> bool:
    """Create the file ``path`` with ``content`` as a whole; false if it exists already.

    The content goes to a hidden file first. On a shared file system that is then
    renamed, which fails where the name is taken (HDFS and its relatives do this in
    one step). Renaming local files would replace them, so they are linked (``link``).
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    files = target.getFileSystem(configuration)
    out = files.create(draft, False)
    out.write(bytearray((json.dumps(content) + "\n").encode()))
    out.close()
    if link is None:
        link = files.getUri().getScheme() == "file"
    try:
        if link:
            local = [jvm.java.io.File(files.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
            return True
        never = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        never[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), configuration)
        context.rename(files.makeQualified(draft), files.makeQualified(target), never)
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        files.delete(draft, False)


def publish_snapshot(df: DataFrame, root: str, at: dt.datetime | str) -> str:
    """Write ``df`` as the snapshot of time ``at`` and make it the current one; ValueError if that time is taken."""
    spark, stamp = df.sparkSession, _stamp(at)
    taken = f"snapshot {stamp} is already published"
    if _is_published(spark, root, stamp):
        raise ValueError(taken)
    folder = f"{stamp}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/data/{folder}")
    if not _commit(spark, f"{root}/commits/{stamp}", {"snapshot_ts": stamp, "folder": folder}):
        raise ValueError(taken)
    return f"{root}/data/{folder}"


def read_snapshot(spark: SparkSession, root: str, at: dt.datetime | str | None = None) -> DataFrame:
    """The latest snapshot, or the latest one not after ``at``."""
    commits = _commits(spark, root)
    if commits is not None and at is not None:
        commits = commits.filter(F.col("snapshot_ts") <= _stamp(at))
    latest = commits.orderBy(F.desc("snapshot_ts")).first() if commits is not None else None
    if latest is None:
        raise ValueError(f"no snapshot below {root}")
    return spark.read.parquet(f"{root}/data/{latest['folder']}")
