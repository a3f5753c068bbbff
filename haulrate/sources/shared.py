"""A folder every executor can read and write."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the session's checkpoint folder, removed when the session's JVM ends.

    A session whose executors are threads of one JVM may leave the setting out: it then uses
    its warehouse folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    file_system(spark, path).deleteOnExit(hadoop_path(spark, path))
    return path


def remove_staged(spark: SparkSession, path: str) -> None:
    """Removes a path that ``shared_folder`` gave, once nothing reads it any more."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def staged(df: DataFrame, purpose: str = "stage", rows_in_file: int = 0) -> DataFrame:
    """The rows written once to the shared folder, for a frame that is read several times.

    Unlike a cache it survives lost executors, and the plan behind it is not repeated. Very large
    rows ask for few in a file (0: no limit), as readers take thousands of a file's rows at once.
    """
    path = shared_folder(df.sparkSession, purpose)
    writer = df.write.option("maxRecordsPerFile", rows_in_file) if rows_in_file else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The path as Hadoop's file systems take it."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that holds the path."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
