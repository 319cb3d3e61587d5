"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, as the cluster names it. Only a local master may go without; it gets a temporary folder, one for each application."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="chronosift-")
    return _OWN[sc.applicationId]


def durable(df: DataFrame) -> DataFrame:
    """The rows as computed once, kept by Spark's checkpoint under spark.checkpoint.dir; after a lost executor they are read, not computed, again."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def laid_down(df: DataFrame):
    """The rows as Parquet in the shared folder while they are read several times, whatever it took to make them; they go at the end."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/laid-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
