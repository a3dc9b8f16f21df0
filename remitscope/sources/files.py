"""Raw records from files that carry the columns of a topic, or one JSON value per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope import schema as S


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RAW_RECORD).parquet(path)


def stream_records(
    spark: SparkSession, path: str, max_files: int = 1000, schema=S.RAW_RECORD
) -> DataFrame:
    """The files of a folder as a stream, oldest first, ``max_files`` in a micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text as record values. Lines are not parsed here, so bad ones reach the decoder."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("value"))
