"""Cut the lineage of a result that many later steps read; folders for tables that jobs leave for later steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, a local session, as in tests, gets a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Write ``df`` as a reliable checkpoint, so that plans built on it stay small and lost executors cost little."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``settled``, but as a compressed table in the shared folder: for tables of many rows, whose order does not matter."""
    path = new_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
