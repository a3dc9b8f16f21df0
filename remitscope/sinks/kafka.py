"""Enriched events to a Kafka topic, keyed by payment."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from remitscope.config import JobParams
from remitscope.operators.encode import encode, enriched_json, record_key
from remitscope.sinks.port import EventSink


def kafka_sink_options(params: JobParams) -> dict[str, str]:
    """Options of Spark's Kafka sink, whose producer makes the attempts at each record."""
    pause = round(params.retry.initial_backoff * 1000)
    attempts = params.retry.max_attempts
    return {
        "kafka.bootstrap.servers": ",".join(params.brokers),
        "topic": params.output_topic,
        "kafka.compression.type": "none",
        "kafka.retries": str(attempts - 1),
        "kafka.retry.backoff.ms": str(pause),
        "kafka.request.timeout.ms": str(params.publish_timeout_ms),
        "kafka.delivery.timeout.ms": str(attempts * (params.publish_timeout_ms + pause)),
    }


def start_topic(enriched: DataFrame, params: JobParams, checkpoint: str) -> StreamingQuery:
    """Streams enriched events into the topic by Spark's connector, without dead letters: a record
    that cannot be delivered fails the query."""
    writer = encode(enriched).writeStream.format("kafka").options(**kafka_sink_options(params))
    return writer.option("checkpointLocation", checkpoint).trigger(**params.trigger).start()


class KafkaEventSink(EventSink):
    """The topic as a sink of single events, for :class:`remitscope.sinks.publish.BatchPublisher`.

    Needs ``confluent_kafka`` on the executors. The client sends each record once: the publisher
    makes the attempts. Up to ``concurrency`` records of a task are under way at a time.
    """

    concurrency = 32

    def __init__(self, params: JobParams):
        self.params = params
        self.producer = None

    def payload(self) -> list[Column]:
        return [record_key().alias("key"), enriched_json().alias("value")]

    def settings(self) -> dict[str, Any]:
        return {
            "bootstrap.servers": ",".join(self.params.brokers),
            "compression.type": "none",
            "message.send.max.retries": 0,
            "request.timeout.ms": self.params.publish_timeout_ms,
            "delivery.timeout.ms": self.params.publish_timeout_ms,
            "linger.ms": 0,
        }

    def open(self) -> None:
        from confluent_kafka import Producer

        self.producer = Producer(self.settings())

    def publish(self, event: dict[str, Any], timeout: float) -> None:
        outcomes: list[Any] = []
        self.producer.produce(
            self.params.output_topic,
            key=event["key"],
            value=event["value"],
            on_delivery=lambda error, message: outcomes.append(error),
        )
        until = time.monotonic() + timeout
        while not outcomes:
            if time.monotonic() > until:
                raise TimeoutError(f"no answer within {timeout} s")
            self.producer.poll(0.05)
        if outcomes[0] is not None:
            raise OSError(str(outcomes[0]))

    def check(self) -> None:
        """Asks a broker for the topic, which raises if none answers. On the driver, too."""
        from confluent_kafka import Producer

        producer = self.producer or Producer(self.settings())
        producer.list_topics(self.params.output_topic, timeout=self.params.publish_timeout_ms / 1000)

    def close(self) -> None:
        if self.producer is not None:
            self.producer.flush(self.params.publish_timeout_ms / 1000)
            self.producer = None
