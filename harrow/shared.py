"""The folder that all executors share: where frames are checkpointed and tables put between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Where that is unset, a temporary one, if all tasks run in this process; on a
    cluster, whose machines don't share such a folder, that is an error."""
    context = spark.sparkContext
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="harrow-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """The frame, computed and kept in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(hadoop(path), hadoop(new)):
        raise OSError(f"{path} can't be moved to {new}")
