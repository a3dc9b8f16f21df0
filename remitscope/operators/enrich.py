"""Enrichment: risk score, ingest latency and processing time."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.money import is_positive
from remitscope.functions.risk import risk_score
from remitscope.functions.times import elapsed_ms


def enrich(
    events: DataFrame,
    now: Column | None = None,
    risk: Callable[[Column, Column], Column] = risk_score,
) -> DataFrame:
    """Adds ``risk_score``, ``ingest_latency_ms`` and ``processed_at``.

    ``now`` defaults to the current time, which Spark fixes once per query and once per
    micro-batch. ``risk`` takes (direction, minor units), so a model may replace the score.
    """
    now = F.current_timestamp() if now is None else now
    return events.withColumns(
        {
            "risk_score": risk(F.col("direction"), F.col("amount.minor_units")).cast("int"),
            "ingest_latency_ms": elapsed_ms(F.col("occurred_at"), now),
            "processed_at": now,
        }
    )


def is_terminal(status: Column) -> Column:
    return status.isin(S.TERMINAL_STATUSES)


def terminal_events(events: DataFrame) -> DataFrame:
    return events.where(is_terminal(F.col("status")))


def positive_amounts(events: DataFrame) -> DataFrame:
    return events.where(is_positive(F.col("amount.minor_units")))
