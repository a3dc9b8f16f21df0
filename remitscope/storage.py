"""Where intermediate results that cut lineage are kept."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. A local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="remitscope-")


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them from there.

    They survive the loss of executors, and a reader of some rows or columns reads only those;
    ``by`` lays them out by the values of some columns. The tables stay until the folder is
    cleared, as their readers may still run.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4()}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_of(spark: SparkSession, name: str):
    """Hadoop's file classes, a path and the file system that holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(name)
    return hadoop, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    _, mark, files = files_of(spark, f"{path}/_SUCCESS")
    return files.exists(mark)
