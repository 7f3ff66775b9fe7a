"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the folder of ``spark.checkpoint.dir``; a temporary one only where it is unset in local mode."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        path = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not path and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(path or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def scratch(spark, tag: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    path = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, for a table that several passes read a part of each."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
