"""Raw records from a Kafka topic.

Offsets live in the checkpoint of the query that reads, so a restart goes on where the last
committed batch ended. Needs Spark's Kafka connector on the class path.
"""

import json

from pyspark.sql import DataFrame, SparkSession

from remitscope.config import JobParams


def kafka_source_options(params: JobParams) -> dict[str, str]:
    """Options of Spark's Kafka source. Without a partition, all of the topic's are read."""
    topic = params.input_topic
    if params.partition is None:
        where = {"subscribe": topic, "startingOffsets": "earliest"}
    else:
        where = {
            "assign": json.dumps({topic: [params.partition]}),
            "startingOffsets": json.dumps({topic: {str(params.partition): params.start_offset}}),
        }
    return {
        "kafka.bootstrap.servers": ",".join(params.brokers),
        **where,
        "maxOffsetsPerTrigger": str(params.batch_size),
        "minPartitions": str(params.min_partitions),
        "kafka.fetch.min.bytes": str(params.fetch_min_bytes),
        "kafka.fetch.max.bytes": str(params.fetch_max_bytes),
        "kafka.fetch.max.wait.ms": str(params.fetch_max_wait_ms),
    }


def read_topic(spark: SparkSession, params: JobParams) -> DataFrame:
    """The topic as an unbounded stream of raw records."""
    reader = spark.readStream.format("kafka").options(**kafka_source_options(params))
    return reader.load()


def read_topic_once(spark: SparkSession, params: JobParams) -> DataFrame:
    """The topic up to its present end, as a bounded table: for backfills."""
    options = kafka_source_options(params)
    del options["maxOffsetsPerTrigger"]
    return spark.read.format("kafka").options(**options).load()
