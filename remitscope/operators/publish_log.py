"""Outcomes, counters, failure streaks and slow attempts over the log of publish attempts."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.times import epoch_micros

# Attempts per event, consecutive failures to flag, and the time budget.
MAX_ATTEMPTS = 4
FAILURE_THRESHOLD = 5
PUBLISH_BUDGET_MS = 5000


def succeeded(budget_ms: int = PUBLISH_BUDGET_MS) -> Column:
    """An attempt past its time budget counts as failed, whatever the sink answered."""
    return (F.col("outcome") == S.PUBLISHED) & (F.col("duration_ms") <= budget_ms)


def publish_outcomes(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Per event: attempts used, whether one got through, whether they ran out."""
    per_event = log.groupBy("event_id").agg(
        F.count("*").alias("attempts"), F.bool_or(succeeded()).alias("published")
    )
    return per_event.withColumn(
        "exhausted", ~F.col("published") & (F.col("attempts") >= max_attempts)
    )


def published_count(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(F.count_if("published").alias("n"))


def event_counters(events: DataFrame, log: DataFrame) -> DataFrame:
    """Consumed events, published events and failed attempts, as one row.

    Failures count per attempt, and only those that the sink reported: a timeout is not one.
    """
    nothing = F.lit(0).cast("bigint")
    consumed = events.agg(
        F.count("*").alias("consumed"),
        nothing.alias("published"),
        nothing.alias("publish_failed"),
    )
    attempts = log.agg(
        nothing.alias("consumed"),
        F.count_if(F.col("outcome") == S.PUBLISHED).alias("published"),
        F.count_if(F.col("outcome") == S.FAILED).alias("publish_failed"),
    )
    names = consumed.columns
    return consumed.unionByName(attempts).agg(*[F.sum(name).alias(name) for name in names])


def slow_publishes(log: DataFrame, budget_ms: int = PUBLISH_BUDGET_MS) -> DataFrame:
    return log.where(F.col("duration_ms") > budget_ms).select("event_id", "attempt", "duration_ms")


_SEGMENT = (
    "sink_key string, ts_us bigint, event_id bigint, attempt int, "
    "streak_len bigint, ends boolean, continues boolean, at_edge boolean"
)


def _segments(rows: pd.DataFrame) -> pd.DataFrame:
    """Cuts sorted rows after each success and at each change of key."""
    ok, key = rows["ok"].to_numpy(), rows["sink_key"].to_numpy()
    first = np.flatnonzero(np.r_[True, ok[:-1] | (key[1:] != key[:-1])])
    last = np.r_[first[1:], len(rows)] - 1
    ends = ok[last]
    return (
        rows.iloc[first]
        .drop(columns="ok")
        .assign(streak_len=last - first + 1 - ends, ends=ends, continues=False, at_edge=False)
    )


def _local_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of one sorted partition; a segment of failures alone may span batches.

    ``ends`` tells that a segment holds the success after its failures. The first and the last
    segment of the partition may belong to a longer one, so they leave marked ``at_edge``, the
    first one also ``continues``. All others are whole, and matter only if they hold failures.
    """
    is_first = True
    held = None  # last segment so far, which the next batch may go on with
    for rows in batches:
        if rows.empty:
            continue
        found = _segments(rows)
        if held is not None:
            next_one = found.iloc[0]
            if not held["ends"].iat[0] and held["sink_key"].iat[0] == next_one["sink_key"]:
                held = held.assign(
                    streak_len=held["streak_len"] + next_one["streak_len"], ends=next_one["ends"]
                )
                found = found.iloc[1:]
            found = pd.concat([held, found])
        held, found = found.iloc[-1:], found.iloc[:-1]
        if is_first and len(found):
            found.iloc[:1] = found.iloc[:1].assign(continues=True, at_edge=True)
            is_first = False
        yield found[found["at_edge"] | (found["streak_len"] > 0)]
    if held is not None:
        yield held.assign(continues=is_first, at_edge=is_first | ~held["ends"])


def failure_streaks(
    log: DataFrame, threshold: int = FAILURE_THRESHOLD, partitions: int | None = None
) -> DataFrame:
    """Maximal runs of failed attempts per sink, in order of (ts, event_id, attempt).

    The log is range-partitioned on the sink *and* the order, so a sink that holds most of the
    rows spreads over many tasks, and copies of one attempt do by their place in the input. Each
    task cuts its sorted stretch into segments in one pass over Arrow batches. Of these, two per
    partition at most touch its edge and are joined up by sink; the whole ones only pass through
    the same step, spread by a hash.
    """
    order = ["sink_key", "ts_us", "event_id", "attempt", "ok"]
    attempts = log.select(
        "sink_key",
        epoch_micros(F.col("ts")).alias("ts_us"),
        "event_id",
        "attempt",
        succeeded().alias("ok"),
        F.monotonically_increasing_id().alias("place"),
    )
    count = [partitions] if partitions else []
    segments = (
        attempts.repartitionByRange(*count, *order, "place")
        .select(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(_local_segments, _SEGMENT)
        .withColumn("apart", F.when(~F.col("at_edge"), F.xxhash64("ts_us", "event_id", "attempt")))
    )
    in_order = Window.partitionBy("sink_key", "apart").orderBy("ts_us", "event_id", "attempt")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joins = F.col("continues") & ~F.lag("ends", 1, True).over(in_order)
    failing = F.col("streak_len") > 0
    return (
        segments.withColumn("begins", (~joins).cast("int"))
        .withColumn("streak", F.sum("begins").over(so_far))
        .groupBy("sink_key", "apart", "streak")
        .agg(
            F.min(F.when(failing, F.col("ts_us"))).alias("start_us"),
            F.sum("streak_len").alias("streak_len"),
        )
        .where(failing)
        .select(
            "sink_key",
            F.timestamp_micros("start_us").alias("streak_start"),
            "streak_len",
            (F.col("streak_len") >= threshold).alias("reached_threshold"),
        )
    )
