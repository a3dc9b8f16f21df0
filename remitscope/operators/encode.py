"""Enriched events as records for a topic: UUID bytes as key, flat JSON as value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.identifiers import uuid_bytes


def _json(fields: list[str]) -> Column:
    return F.to_json(F.struct(*fields), {"timestampFormat": S.JSON_TIMESTAMP_FORMAT, "timeZone": "UTC"})


def event_json() -> Column:
    """A payment event as JSON text."""
    return _json(S.PAYMENT_EVENT.fieldNames())


def enriched_json() -> Column:
    """An enriched event as one flat JSON object; only the amount stays nested."""
    return _json(S.ENRICHED_EVENT.fieldNames())


def record_key() -> Column:
    return uuid_bytes(F.col("payment_id"))


def encode(enriched: DataFrame) -> DataFrame:
    """The ``key`` and ``value`` columns that Spark's Kafka sink expects."""
    return enriched.select(record_key().alias("key"), enriched_json().alias("value"))
