"""Job parameters and connector options."""

import json

import pytest

from remitscope.config import JobParams, RetryPolicy
from remitscope.sinks.kafka import kafka_sink_options
from remitscope.sources.kafka import kafka_source_options


def test_defaults():
    params = JobParams.from_env({})
    assert params == JobParams()
    assert params.brokers == ("localhost:9092",)
    assert (params.input_topic, params.output_topic) == ("payments.events", "payments.enriched")
    assert (params.partition, params.batch_size, params.idle_backoff_ms) == (0, 256, 200)
    assert params.trigger == {"processingTime": "200 milliseconds"}


def test_environment():
    params = JobParams.from_env(
        {
            "REMITSCOPE_KAFKA": "a:1, b:2 ,c:3",
            "REMITSCOPE_INPUT_TOPIC": "in",
            "REMITSCOPE_OUTPUT_TOPIC": "out",
            "REMITSCOPE_PARTITION": "7",
        }
    )
    assert params.brokers == ("a:1", "b:2", "c:3")
    assert (params.input_topic, params.output_topic, params.partition) == ("in", "out", 7)


@pytest.mark.parametrize("text", ["", "x", "1.5", " 1", "2147483648"])
def test_bad_partition(text):
    with pytest.raises(ValueError, match="REMITSCOPE_PARTITION"):
        JobParams.from_env({"REMITSCOPE_PARTITION": text})


def test_source_options():
    options = kafka_source_options(JobParams(partition=3, start_offset=42))
    assert json.loads(options["assign"]) == {"payments.events": [3]}
    assert json.loads(options["startingOffsets"]) == {"payments.events": {"3": 42}}
    assert options["maxOffsetsPerTrigger"] == "256"
    assert options["minPartitions"] == "32"
    assert options["kafka.fetch.min.bytes"] == "1"
    assert options["kafka.fetch.max.bytes"] == "10000000"
    assert options["kafka.fetch.max.wait.ms"] == "500"


def test_cluster_reads_all_partitions():
    options = kafka_source_options(JobParams(brokers=("a:1", "b:2")).for_cluster())
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert options["subscribe"] == "payments.events"
    assert options["startingOffsets"] == "earliest"
    assert "assign" not in options


def test_sink_options():
    options = kafka_sink_options(JobParams())
    assert options["topic"] == "payments.enriched"
    assert options["kafka.compression.type"] == "none"
    # The producer makes the attempts of the retry policy.
    assert options["kafka.retries"] == "3" and options["kafka.retry.backoff.ms"] == "50"
    # Kafka demands that the delivery timeout covers a request.
    assert int(options["kafka.delivery.timeout.ms"]) >= int(options["kafka.request.timeout.ms"])


def test_backoff_doubles_up_to_its_cap():
    policy = RetryPolicy()
    assert [policy.backoff(n) for n in (1, 2, 3, 20)] == [0.05, 0.1, 0.2, 5.0]
