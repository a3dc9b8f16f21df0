"""Publishing a micro-batch event by event inside tasks: retries, dead letters, attempt log, ledger."""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from threading import Lock
from typing import Any

import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitscope import schema as S
from remitscope.config import RetryPolicy
from remitscope.sinks.port import EventSink, SinkDown, attempt
from remitscope.storage import files_of, is_whole

_LEDGER = "attempts bigint, events bigint, published bigint, dead bigint, error string"
_METRICS = "consumed bigint, rejected bigint, published bigint, publish_failed bigint"
_ATTEMPTS = "array<struct<ts: timestamp, outcome: string, duration_ms: bigint>>"
_ATTEMPT_TYPE = pa.struct(
    [("ts", pa.timestamp("us", tz="UTC")), ("outcome", pa.string()), ("duration_ms", pa.int64())]
)

Attempts = list[dict[str, Any]]


class _Task:
    """The events of one task on their way to the sink, each with all its own attempts."""

    def __init__(self, sink: EventSink, retry: RetryPolicy, budget: float, give_up_after: int):
        self.sink, self.retry, self.budget, self.give_up_after = sink, retry, budget, give_up_after
        self.lock = Lock()
        self.in_a_row = 0  # events that failed for good since the last one that got through
        self.taken: dict | None = None  # the last event that got through
        self.down: Exception | None = None

    def send(self, event: dict[str, Any]) -> tuple[bool, Attempts, str | None]:
        """Whether the event got through, its attempts, and the last failure."""
        if self.down is not None:
            raise self.down
        published, attempts, error = self._with_retries(event)
        with self.lock:
            if published:
                self.in_a_row, self.taken = 0, event
            else:
                self.in_a_row += 1
                if self.in_a_row % self.give_up_after == 0:
                    self._ask_sink(error)
        return published, attempts, error

    def _with_retries(self, event: dict[str, Any]) -> tuple[bool, Attempts, str | None]:
        attempts, error = [], None
        for number in range(1, self.retry.max_attempts + 1):
            began = datetime.now(timezone.utc)
            failure, seconds = attempt(self.sink, event, self.budget)
            outcome = S.PUBLISHED
            if failure is not None:
                outcome = S.TIMED_OUT if isinstance(failure, TimeoutError) else S.FAILED
                error = str(failure) or type(failure).__name__
            attempts.append({"ts": began, "outcome": outcome, "duration_ms": round(seconds * 1000)})
            if failure is None:
                return True, attempts, None
            if number < self.retry.max_attempts:
                time.sleep(self.retry.backoff(number))
        return False, attempts, error

    def _ask_sink(self, error: str | None) -> None:
        """Raises if so many failures mean that the sink is down, rather than that events are bad."""
        try:
            try:
                self.sink.check()
                return
            except NotImplementedError:  # the sink cannot tell: what it took before, it should take again
                if self.taken is None:
                    raise SinkDown(f"{self.in_a_row} events failed and none got through: {error}") from None
                published, _, again = self._with_retries(self.taken)
                if not published:
                    raise SinkDown(f"refuses an event that it took before: {again}") from None
        except Exception as failure:
            self.down = failure if isinstance(failure, SinkDown) else SinkDown(str(failure))
            raise self.down from failure


def _publisher(sink: EventSink, retry: RetryPolicy, budget: float, give_up_after: int):
    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task(sink, retry, budget, give_up_after)

        def rows(numbers: list, sent: list, events: pa.Array, message: bytes | None = None) -> pa.RecordBatch:
            published = [s[0] for s in sent]
            own = events.take(pa.array([None if p else i for i, p in enumerate(published)], pa.int64()))
            columns = [
                pa.array(numbers, pa.int64()),
                pa.array(published, pa.bool_()),
                pa.array([s[1] for s in sent], pa.list_(_ATTEMPT_TYPE)),
                pa.array([s[2] for s in sent], pa.string()),
                own,
                pa.nulls(len(numbers), pa.binary()),
            ]
            if message is not None:
                columns = [pa.nulls(1, column.type) for column in columns[:-1]] + [pa.array([message], pa.binary())]
            names = ["event_no", "published", "attempts", "error", "event", "message"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        sink.open()
        try:
            events = None
            with ThreadPoolExecutor(max_workers=sink.concurrency) as pool:
                for batch in batches:
                    payload = batch.column("payload").to_pylist()
                    events = batch.column("event")
                    numbers = batch.column("event_no").to_pylist()
                    if sink.concurrency == 1:
                        sent = [task.send(event) for event in payload]
                    else:
                        sent = list(pool.map(task.send, payload))
                    yield rows(numbers, sent, events)
            message = sink.flush()
            if message is not None and events is not None:
                yield rows([], [], events.slice(0, 0), pickle.dumps(message))
        finally:
            sink.close()

    return publish


class BatchPublisher:
    """``foreachBatch`` function that publishes each micro-batch of events into a sink.

    All happens in one pass over the batch, inside the tasks: each event gets its own attempts, up to
    the retry policy's limit and with its pauses, ``sink.concurrency`` of them at a time. An event
    whose attempts all failed, and no other, goes to the dead letters. After ``give_up_after``
    events of a task in a row have failed for good, the sink is asked whether it is down, or, where
    it cannot tell, the last event that it took is sent again; if it is down, or took nothing at all
    so far, the batch raises :class:`SinkDown`, to be replayed. A batch of which nothing got through
    asks the sink too. So a sink that cannot tell needs no more than ``give_up_after`` bad events in
    a row before its first good one.

    Everything is kept by query and batch, the query by the id that its checkpoint holds: a new
    checkpoint publishes anew. The outcomes of a batch are a table, a row per event; dead letters and
    the publish log are read from it. A batch replayed after a crash is published again unless its
    outcomes were written. So it is at least once towards the sink (exactly once if the sink shows
    committed batches only), exactly once in ledger, log and counters.
    """

    def __init__(
        self,
        sink: EventSink,
        folder: str,
        retry: RetryPolicy = RetryPolicy(),
        sink_key: str = "sink",
        give_up_after: int = 64,
        budget_ms: int = 5_000,
    ):
        self.sink, self.folder, self.retry = sink, folder, retry
        self.sink_key, self.give_up_after, self.budget_ms = sink_key, give_up_after, budget_ms

    def __call__(
        self,
        batch: DataFrame,
        batch_id: int,
        counts: Callable[[bool], tuple[int, int]] | None = None,
    ) -> None:
        """``counts`` gives consumed and rejected records once the batch has been read, or, if told
        False, where it has not, as an earlier run had read it."""
        spark = batch.sparkSession
        query = query_id(spark)
        place = f"query_id={query}/batch_id={batch_id}"
        if is_whole(spark, f"{self.folder}/ledger/{place}"):
            return
        path = f"{self.folder}/outcomes/{place}"
        is_new = not is_whole(spark, path)
        if is_new:
            self._publish(batch, path, place)
        found = spark.read.schema(_outcome_schema(batch)).parquet(path)
        totals = found.where("message IS NULL").agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if("published").alias("published"),
            F.coalesce(F.sum(F.size("attempts")), F.lit(0)).alias("attempts"),
            F.coalesce(F.sum(F.size(F.filter("attempts", lambda a: a["outcome"] == S.FAILED))), F.lit(0)).alias("failures"),
            F.max("error").alias("error"),
        )
        row = totals.first()
        if row["events"] and not row["published"]:
            self._ask_sink(spark, path)
        messages = [pickle.loads(m[0]) for m in found.select("message").where("message IS NOT NULL").collect()]
        self.sink.commit(f"{query}-{batch_id}", messages)  # one per task
        consumed, rejected = (row["events"], 0) if counts is None else counts(is_new)
        metrics = (consumed, rejected, row["published"], row["failures"])
        self._row(spark, metrics, _METRICS, f"metrics/{place}")
        ledger = (row["attempts"], row["events"], row["published"], row["events"] - row["published"], row["error"])
        self._row(spark, ledger, _LEDGER, f"ledger/{place}")

    def _publish(self, batch: DataFrame, path: str, place: str) -> None:
        payload = self.sink.payload() or batch.columns
        given = batch.select(
            F.xxhash64(F.lit(place), F.monotonically_increasing_id()).alias("event_no"),
            F.struct(*batch.columns).alias("event"),
            F.struct(*payload).alias("payload"),
        )
        schema = _outcome_schema(batch)
        publish = _publisher(self.sink, self.retry, self.budget_ms / 1000, self.give_up_after)
        outcomes = given.mapInArrow(publish, schema).withColumn("sink_key", F.lit(self.sink_key))
        try:
            outcomes.write.mode("overwrite").parquet(path)
        except PythonException as failure:
            if SinkDown.__name__ in str(failure):
                raise SinkDown(_last_line(str(failure))) from failure
            raise

    def _ask_sink(self, spark: SparkSession, path: str) -> None:
        """Raises if nothing got through because the sink is down; the batch is then as if untried."""
        try:
            self.sink.check()
        except NotImplementedError:
            return
        except Exception as failure:
            _, hadoop_path, files = files_of(spark, path)
            files.delete(hadoop_path, True)
            raise SinkDown(str(failure)) from failure

    def _row(self, spark: SparkSession, row: tuple, schema: str, place: str) -> None:
        frame = spark.createDataFrame([row], schema).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.folder}/{place}")


def _last_line(text: str) -> str:
    lines = [line for line in text.splitlines() if SinkDown.__name__ in line]
    return lines[-1].strip() if lines else text


def _outcome_schema(batch: DataFrame) -> T.StructType:
    event = T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema])
    outcome = T.StructType.fromDDL(f"event_no bigint, published boolean, attempts {_ATTEMPTS}, error string")
    return outcome.add("event", event).add("message", T.BinaryType())


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query that runs this batch, which its checkpoint holds."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts, events, published events and dead letters per query and micro-batch."""
    return spark.read.parquet(f"{folder}/ledger")


def _finished(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    finished = read_ledger(spark, folder).select("query_id", "batch_id")
    return rows.join(finished, ["query_id", "batch_id"], "left_semi")


def read_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """The events of finished batches that no attempt got through, with the query and batch."""
    outcomes = _finished(spark, folder, spark.read.parquet(f"{folder}/outcomes"))
    return outcomes.where(~F.col("published")).select("event.*", "error", "query_id", "batch_id")


def read_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """The publish log: a row for each event and attempt of the finished batches."""
    outcomes = spark.read.parquet(f"{folder}/outcomes").where("message IS NULL")
    log = _finished(spark, folder, outcomes).select("event_no", "sink_key", F.posexplode("attempts"))
    return log.select(
        F.col("event_no").alias("event_id"),
        (F.col("pos") + 1).alias("attempt"),
        "sink_key",
        "col.ts",
        "col.outcome",
        "col.duration_ms",
    )


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Consumed, rejected, published and failed per query and finished micro-batch."""
    return _finished(spark, folder, spark.read.parquet(f"{folder}/metrics"))
