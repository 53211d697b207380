"""The folder that driver and executors share, and intermediate tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is made only where the session names none and is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skyweave-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def intermediates(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables and files."""
    return f"{shared_dir(spark)}/skyweave/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """A name for a new folder among them."""
    return f"{intermediates(spark)}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Removes this application's intermediate tables, once the results that read them have been written."""
    remove(spark, intermediates(spark))
