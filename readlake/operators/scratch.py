"""Tables that an operator writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. One of our own only in a local session where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def own_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; what is there goes when the session's Python process ends."""
    path = f"{shared_dir(spark)}/readlake-{uuid.uuid4().hex}"

    def drop() -> None:
        with contextlib.suppress(Exception):
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    atexit.register(drop)
    return path


def table(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors.

    The files go when the session's Python process ends.
    """
    spark = df.sparkSession
    path = own_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
