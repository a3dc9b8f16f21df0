"""The continuous jobs: publish enriched events, keep the read model, quarantine bad records.

All three read the same raw records and decode them with the same operators as a batch would. They
are separate queries with a checkpoint each, because an event counts in the read model whether or
not it gets published.
"""

import logging
from collections.abc import Callable
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from remitscope.operators import aggregates, decode
from remitscope.operators.enrich import enrich
from remitscope.sinks.publish import BatchPublisher, read_metrics
from remitscope.sinks.snapshot import SnapshotWriter

_log = logging.getLogger(__name__)

AVAILABLE_NOW = {"availableNow": True}


def decode_counts() -> list[Column]:
    reason = F.col("reject_reason")
    return [
        F.count_if(reason.isNull()).alias("consumed"),
        F.count_if(reason != "tombstone").alias("rejected"),
    ]


def enriched_events(records: DataFrame) -> DataFrame:
    """Decoded and enriched events. The query reports consumed and rejected records."""
    decoded = decode.decode(records).observe("decode", *decode_counts())
    return enrich(decode.events_only(decoded))


def start_publish(
    records: DataFrame,
    publisher: BatchPublisher,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Publishes the events; the publisher keeps consumed and rejected records of each batch too.

    They are observed while the events are published. Only where an earlier run had done that,
    and crashed before it noted the numbers, are the records counted by themselves.
    """

    def publish(decoded: DataFrame, batch_id: int) -> None:
        seen = Observation("decode")

        def counts(was_read: bool) -> tuple[int, int]:
            if was_read:
                return seen.get["consumed"], seen.get["rejected"]
            return tuple(decoded.agg(*decode_counts()).first())

        observed = decoded.observe(seen, *decode_counts())
        publisher(enrich(decode.events_only(observed)), batch_id, counts)

    return (
        decode.decode(records)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_read_model(
    records: DataFrame, folder: str, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Running aggregates since the start. The state is the partial rows, 128 at most, so it
    needs no watermark."""
    return (
        aggregates.partial_aggregates(enriched_events(records))
        .writeStream.outputMode("complete")
        .foreachBatch(SnapshotWriter(folder))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_quarantine(
    records: DataFrame, folder: str, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Rejected records, as they came, with the reason."""
    kept = [c for c in ("topic", "partition", "offset", "value") if c in records.columns]
    return (
        decode.rejected(decode.decode(records))
        .select(*kept, "reject_reason")
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def reported(spark: SparkSession, folder: str) -> dict[str, int]:
    """Totals over all finished micro-batches of a publisher's folder: consumed and rejected
    records, published events, and attempts that failed, counted per event."""
    names = ["consumed", "rejected", "published", "publish_failed"]
    totals = read_metrics(spark, folder).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return totals.first().asDict()


def run_once(
    records: DataFrame, publisher: BatchPublisher, checkpoint: str, trigger: dict = AVAILABLE_NOW
) -> int:
    """Publishes what there is and returns the number of events published by this run."""
    before = _last_batches(records.sparkSession, publisher.folder)
    query = start_publish(records, publisher, checkpoint, trigger)
    query.awaitTermination()
    last = before.get(str(query.id), -1)
    try:
        metrics = read_metrics(records.sparkSession, publisher.folder)
    except AnalysisException:  # nothing was ever published there
        return 0
    own = metrics.where((F.col("query_id") == str(query.id)) & (F.col("batch_id") > last))
    return own.agg(F.coalesce(F.sum("published"), F.lit(0))).first()[0]


def _last_batches(spark: SparkSession, folder: str) -> dict[str, int]:
    """The last finished batch of each query that has published to the folder."""
    try:
        rows = read_metrics(spark, folder).groupBy("query_id").agg(F.max("batch_id")).collect()
    except AnalysisException:
        return {}
    return {str(query): batch for query, batch in rows}


def run_until(stop: Event, start: Callable[[], StreamingQuery], backoff: float = 0.2) -> None:
    """Keeps a query running. One that fails starts again from its checkpoint after a pause, and a
    batch cut off by the stop is done again at the next start."""
    while not stop.is_set():
        try:
            query = start()
            while not stop.is_set():
                if query.awaitTermination(backoff):
                    break
            query.stop()
        except Exception as failure:
            _log.error("query failed, restarting: %s", failure)
        stop.wait(backoff)
