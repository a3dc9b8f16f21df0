"""Token-bucket admission on a stream.

:func:`token_bucket_admission` keeps each key's bucket in Spark's state store, so that one task handles
a key's rows of a micro-batch. :class:`BatchAdmission` splits the rows of a key over tasks, as in batch,
and keeps the buckets in a table.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from remitscope.functions.times import epoch_micros
from remitscope.operators.admission import STATES, BucketState, TokenBucket, admission_with_states
from remitscope.sinks.publish import query_id
from remitscope.storage import files_of, is_whole

# Longer than any stream runs: a century.
NEVER_US = 100 * 366 * 86_400 * 1_000_000
_STATE = "last_us bigint, credit string"  # text holds credit of any size


def _until_full_us(bucket: TokenBucket, state: BucketState) -> int:
    return -(-(bucket.full - state.credit) // bucket.gain) if bucket.gain else NEVER_US


def _admit(bucket: TokenBucket, forgets: str):
    def admit(key: tuple, batches: Iterator[pd.DataFrame], kept: GroupState):
        if kept.hasTimedOut:  # the bucket is full again, which equals having no state
            kept.remove()
            return
        rows = pd.concat([batch[["id", "key", "us"]] for batch in batches]).sort_values(["us", "id"])
        times = rows["us"].tolist()
        if kept.exists:
            last_us, credit = kept.get
            state = BucketState(last_us, int(credit))
        else:
            state = BucketState(times[0], bucket.full)
        rows["admitted"] = state.admit(bucket, times)
        kept.update((state.last_us, str(state.credit)))
        left_ms = min(_until_full_us(bucket, state), NEVER_US) // 1000 + 1
        if forgets == GroupStateTimeout.ProcessingTimeTimeout:
            kept.setTimeoutDuration(left_ms)
        elif forgets == GroupStateTimeout.EventTimeTimeout:
            full_at = state.last_us // 1000 + left_ms
            kept.setTimeoutTimestamp(max(full_at, kept.getCurrentWatermarkMs() + 1))
        yield rows[["id", "key", "admitted"]]

    return admit


def token_bucket_admission(
    events: DataFrame,
    bucket: TokenBucket,
    key: str = "user_id",
    ts: str = "ts",
    event_id: str = "event_id",
    now: Column | None = None,
    lateness: str | None = None,
    forget_idle: bool = False,
) -> DataFrame:
    """Like the batch operator, with the state of each key kept between micro-batches.

    Events are put in order within a micro-batch; one that arrives in a later batch than its
    successor finds the bucket as that left it. ``now`` replaces event time, as
    ``current_timestamp()`` does for a limit on the wall clock. A task holds the id and time of the
    rows of one key in one micro-batch, which the source's batch size bounds. With ``lateness``,
    Spark drops events behind the watermark before they get here: they have no row in the result.

    A key's state goes once its bucket is full again: with ``lateness``, when the watermark, that
    far behind the latest event, has passed the time; with ``now`` and ``forget_idle``, by the
    clock, which needs a trigger that goes on (a run over what there is would not end).
    """
    moment = F.col(ts) if now is None else now
    forgets = GroupStateTimeout.NoTimeout
    if now is not None and forget_idle:
        forgets = GroupStateTimeout.ProcessingTimeTimeout
    elif now is None and lateness is not None:
        forgets = GroupStateTimeout.EventTimeTimeout
        events = events.withWatermark(ts, lateness)
    output = T.StructType(
        [
            T.StructField("id", events.schema[event_id].dataType),
            T.StructField("key", events.schema[key].dataType),
            T.StructField("admitted", T.BooleanType()),
        ]
    )
    return (
        events.select(
            F.col(key).alias("key"),
            epoch_micros(moment).alias("us"),
            F.col(event_id).alias("id"),
            F.col(ts).alias("ts"),  # carries the watermark
        )
        .groupBy("key")
        .applyInPandasWithState(_admit(bucket, forgets), output, _STATE, "append", forgets)
        .select(F.col("id").alias(event_id), F.col("key").alias(key), "admitted")
    )


def _not_full(bucket: TokenBucket, now_us: int):
    """Leaves out the states of buckets that are full again, which equals having no state."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            given = zip(rows["last_us"].tolist(), rows["credit"].tolist())
            held = [int(credit) + max(0, now_us - last) * bucket.gain < bucket.full for last, credit in given]
            yield rows[pd.Series(held, index=rows.index, dtype=bool)]

    return keep


class BatchAdmission:
    """``foreachBatch`` function that decides on the events of each micro-batch and hands the decisions
    to ``write(decisions, batch_id)``.

    A micro-batch is folded as the batch operator folds a table: dealt by ranges of key and time, so a
    key with a third of all rows spreads over tasks, whose folds are composed as functions of the
    credit before them. The buckets before the batch take part as rows, those after it are written
    to ``folder``, by query and batch, once the decisions are. A batch replayed after a crash starts
    from the same buckets and gives the same decisions; one whose buckets were written is skipped.

    An event that comes in a later batch than its successor finds the bucket as that left it. A
    bucket that is full ``lateness_us`` before the latest event is forgotten. The batch is read
    three times, so it must give the same rows each time, as Spark's own sources do.
    """

    def __init__(
        self,
        bucket: TokenBucket,
        write: Callable[[DataFrame, int], None],
        folder: str,
        key: str = "user_id",
        ts: str = "ts",
        event_id: str = "event_id",
        lateness_us: int = 0,
        partitions: int | None = None,
    ):
        self.bucket, self.write, self.folder, self.lateness_us = bucket, write, folder, lateness_us
        self.key, self.ts, self.event_id, self.partitions = key, ts, event_id, partitions

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{self.folder}/query_id={query_id(spark)}"
        if is_whole(spark, f"{own}/batch_id={batch_id}"):
            return
        before = f"{own}/batch_id={batch_id - 1}"
        if batch_id and not is_whole(spark, before):
            raise ValueError(f"the buckets before batch {batch_id} are not in {own}")
        states = spark.read.schema(STATES).parquet(before) if batch_id else None
        columns = (self.key, self.ts, self.event_id)
        decisions, after = admission_with_states(batch, self.bucket, states, *columns, self.partitions)
        self.write(decisions, batch_id)
        latest = batch.agg(F.max(epoch_micros(F.col(self.ts)))).first()[0]
        if latest is not None:
            after = after.mapInPandas(_not_full(self.bucket, latest - self.lateness_us), STATES)
        after.write.mode("overwrite").parquet(f"{own}/batch_id={batch_id}")
        _, path, files = files_of(spark, f"{own}/batch_id={batch_id - 2}")
        files.delete(path, True)
