"""Folders that the driver and all executors reach, for intermediate tables: cuts lineage, survives lost executors."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder's address below spark.checkpoint.dir; unset, on one machine a temporary one, on a cluster an error. What is left in it when the driver's Python ends is deleted."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: a cluster needs a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="toolgraph-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_late, spark._jvm, spark._jsc.hadoopConfiguration(), path)
    return path


def stored(df: DataFrame, path: str) -> DataFrame:
    """Writes df as Parquet and reads it back; computed once, unlike an eager checkpoint."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whichever store its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove_late(jvm, conf, path: str) -> None:
    """remove, for a session that may have been stopped."""
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    except Exception:  # the JVM has gone: a folder stays
        pass
