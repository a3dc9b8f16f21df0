"""Alerts that run on a stream: failure rates, a source that falls silent, runs of failures.

They need the RocksDB state store (:func:`use_rocksdb`), which keeps their state and their timers.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from remitscope.functions.times import epoch_micros
from remitscope.operators.publish_log import FAILURE_THRESHOLD, succeeded
from remitscope.operators.rates import (
    ALERT_WINDOW_SECONDS,
    EVALUATION_SECONDS,
    FAILURES_HOLD_SECONDS,
    FAILURES_PER_SECOND,
    STALL_HOLD_SECONDS,
)

PENDING, FIRING, RESOLVED, DROPPED = "pending", "firing", "resolved", "dropped"
STALLED, RESUMED = "stalled", "resumed"

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def use_rocksdb(spark: SparkSession) -> None:
    """Lets the queries that start from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


def _moment(us: int) -> datetime:
    return _EPOCH + timedelta(microseconds=us)


class _RateAlert(StatefulProcessor):
    """One alert rule over closed bins of ``step`` seconds, which come in order of time.

    The state is the next evaluation instant, the run of evaluations above the threshold that is
    going on, and the bins of one window. What happens if no further bin comes follows from these,
    so an event-time timer stands at the next change.
    """

    def __init__(self, most: float, hold: int, width: int, step: int):
        self.most, self.hold, self.width, self.step = most, hold, width, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bins = handle.getMapState("bins", "bin bigint", "n bigint")
        self.run = handle.getValueState("run", "tick bigint, first bigint, last bigint, state string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).groupby("bin")["n"].sum().sort_index()
        yield from self._advance({int(b): int(n) for b, n in found.items()}, int(found.index[-1]) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick = expiredTimerInfo.getExpiryTimeInMs() // (1000 * self.step)
        yield from self._advance({}, tick)

    def close(self) -> None:
        pass

    def _advance(self, new: dict[int, int], upto: int) -> Iterator[pd.DataFrame]:
        """Evaluates all instants up to one, given the bins before it."""
        bins = {k[0]: v[0] for k, v in self.bins.iterator()} | new
        tick, first, last, state = self.run.get() if self.run.exists() else (min(bins, default=upto), None, None, None)
        changes = []
        while tick <= upto:
            if not bins or max(bins) + self.width < tick and first is None:
                tick = upto + 1
                break
            step_state = self._evaluate(bins, tick, first, last, state)
            if step_state[:3] != (first, last, state):
                first, last, state, change = step_state
                if change:
                    changes.append(change)
            tick += 1
        gone = [b for b in bins if b < tick - self.width]
        for b in gone:
            del bins[b]
        self.bins.clear()
        for b, n in bins.items():
            self.bins.updateValue((b,), (n,))
        self.run.update((tick, first, last, state))
        self._arm(bins, tick, first, last, state)
        rows = [(s, _moment(a * self.step * 10**6), _moment(b * self.step * 10**6), b - a + 1) for s, a, b in changes]
        yield pd.DataFrame(rows, columns=["state", "start", "end", "evaluations"])

    def _evaluate(self, bins, tick, first, last, state):
        """The run after an instant, and the change of state that it brings, if any."""
        n = sum(bins.get(b, 0) for b in range(tick - self.width, tick))
        if n / (self.width * self.step) > self.most:
            begins = first is None
            first, last = (tick, tick) if begins else (first, tick)
            if state != FIRING and (last - first) * self.step >= self.hold:
                return first, last, FIRING, (FIRING, first, last)
            return first, last, PENDING if begins else state, (PENDING, first, last) if begins else None
        if first is None:
            return None, None, None, None
        return None, None, None, (RESOLVED if state == FIRING else DROPPED, first, last)

    def _arm(self, bins, tick, first, last, state) -> None:
        """Sets the one timer to the next change, if there is one without further bins."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        end = max(bins, default=tick) + self.width + 1
        for t in range(tick, end + 1):
            first, last, state, change = self._evaluate(bins, t, first, last, state)
            if change:
                self.handle.registerTimer(t * self.step * 1000)
                return


def rate_alerts(
    rows: DataFrame,
    counted: Column | None = None,
    threshold: float = FAILURES_PER_SECOND,
    hold_seconds: int = FAILURES_HOLD_SECONDS,
    seconds: int = ALERT_WINDOW_SECONDS,
    step: int = EVALUATION_SECONDS,
    ts: str = "ts",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Changes of state of a rate alert: state, start, end, evaluations.

    ``pending`` tells that the rate exceeds the threshold, ``firing`` that it has done so for the
    hold time, ``resolved`` that a firing alert is over, ``dropped`` that it never fired. The
    ``resolved`` rows are those of the batch operator. Only rows for which ``counted`` holds count;
    all move time on, so give all rows of the log rather than the failures alone.

    Rows are first counted per bin by Spark's own aggregation, once the watermark has closed the
    bin; the rule's one task sees a row per ``step`` seconds. Rows later than ``lateness`` are left
    out. The state after a window without bins is a few numbers.
    """
    if threshold < 0 or seconds % step:
        raise ValueError("threshold must not be negative, and the window a multiple of the step")
    bins = (
        rows.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{step} seconds"))
        .agg((F.count("*") if counted is None else F.count_if(counted)).alias("n"))
        .select(
            F.lit("rule").alias("rule"),
            F.window_time("window").alias("ts"),
            (F.unix_seconds(F.col("window.start").cast("timestamp")) / step).cast("bigint").alias("bin"),
            "n",
        )
    )
    rule = _RateAlert(threshold, hold_seconds, seconds // step, step)
    schema = "state string, start timestamp, end timestamp, evaluations bigint"
    return bins.groupBy("rule").transformWithStateInPandas(rule, schema, "Append", "EventTime")


class _Silence(StatefulProcessor):
    """One source, watched by the clock. The state is the last event, when it came, and the stall."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_us bigint, came_ms bigint, stalled boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows))
        now, first, last = timerValues.getCurrentProcessingTimeInMs(), int(given["first_us"].min()), int(given["last_us"].max())
        if self.seen.exists():
            last_us, came_ms, stalled = self.seen.get()
            if stalled or now - came_ms >= self.silence_ms:
                if not stalled:
                    yield _stall(STALLED, last_us, None, now - came_ms)
                yield _stall(RESUMED, last_us, first, now - came_ms)
            last = max(last, last_us)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.silence_ms)
        self.seen.update((last, now, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last_us, came_ms, stalled = self.seen.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        if not stalled and now - came_ms >= self.silence_ms:
            self.seen.update((last_us, came_ms, True))
            yield _stall(STALLED, last_us, None, now - came_ms)

    def close(self) -> None:
        pass


_STALLS = "state string, last_ts timestamp, next_ts timestamp, silent_ms bigint"


def _stall(state: str, last_us: int, next_us: int | None, silent_ms: int) -> pd.DataFrame:
    times = [None if us is None else _moment(us) for us in (last_us, next_us)]
    last_ts, next_ts = (pd.Series(pd.to_datetime([t], utc=True)) for t in times)
    return pd.DataFrame({"state": [state], "last_ts": last_ts, "next_ts": next_ts, "silent_ms": [silent_ms]})


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first and last time of a partition, as one row."""
    first = last = None
    for rows in batches:
        us = rows["us"].dropna()
        if len(us):
            first = min(int(us.min()), first if first is not None else int(us.min()))
            last = max(int(us.max()), last if last is not None else int(us.max()))
    if first is not None:
        yield pd.DataFrame({"first_us": [first], "last_us": [last]})


def stalls(
    rows: DataFrame,
    silence_seconds: float = ALERT_WINDOW_SECONDS + STALL_HOLD_SECONDS,
    ts: str = "ts",
) -> DataFrame:
    """Tells, by the clock, when no event has come for ``silence_seconds``, and when one comes again.

    A silence gives one row ``stalled`` with the time of the last event, which needs no input, and
    then one row ``resumed`` with that of the next. ``silent_ms`` is counted from when the last event
    came. Needs a trigger that goes on. Each partition sends the first and last time of a
    micro-batch, so the one task of the alert sees a row per partition. Nothing is told before the
    first event ever; rows without time are left out.
    """
    ends = rows.select(epoch_micros(F.col(ts)).alias("us")).mapInPandas(_ends, "first_us bigint, last_us bigint")
    watched = ends.withColumn("source", F.lit("all")).groupBy("source")
    silence = _Silence(round(silence_seconds * 1000))
    return watched.transformWithStateInPandas(silence, _STALLS, "Append", "ProcessingTime")


class _Streaks(StatefulProcessor):
    """Per sink, the run of failures that is going on, carried from bucket to bucket."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "start_us bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, n = self.open.get() if self.open.exists() else (None, 0)
        out: list[tuple] = []

        def add(start_us: int, length: int, ended: bool) -> None:
            out.append((key[0], _moment(start_us), length, length >= self.threshold, ended))

        for row in pd.concat(list(rows)).sort_values("bucket").itertuples():
            runs = [(int(r["start_us"]), int(r["n"])) for r in row.runs]
            told = False
            if n and runs and row.begins:  # the bucket's first run goes on with the open one
                told = len(runs) == 1 and n >= self.threshold
                runs[0] = (start, n + runs[0][1])
            elif n:
                add(start, n, True)
            closed, (start, n) = (runs[:-1], runs[-1]) if runs and row.ends else (runs, (None, 0))
            for start_us, length in closed:
                add(start_us, length, True)
            if n >= self.threshold and not told:
                add(start, n, False)
        if n:
            self.open.update((start, n))
        elif self.open.exists():
            self.open.clear()
        yield pd.DataFrame(out, columns=["sink_key", "streak_start", "streak_len", "reached_threshold", "ended"])

    def close(self) -> None:
        pass


_BUCKET = "sink_key string, bucket bigint, runs array<struct<start_us: bigint, n: bigint>>, begins boolean, ends boolean"


def _bucket_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of failures in each bucket's sorted attempts, and whether one begins or ends it."""
    for batch in batches:
        attempts = batch.column("attempts")
        firsts = np.asarray(attempts.offsets)[:-1] - attempts.offsets[0].as_py()
        lasts = np.asarray(attempts.offsets)[1:] - attempts.offsets[0].as_py() - 1
        each = attempts.flatten()
        ok = each.field("ok").to_numpy(zero_copy_only=False)
        at_first, at_last = np.zeros(len(ok), bool), np.zeros(len(ok), bool)
        at_first[firsts], at_last[lasts] = True, True
        starts = np.flatnonzero(~ok & (at_first | np.r_[True, ok[:-1]]))
        stops = np.flatnonzero(~ok & (at_last | np.r_[ok[1:], True]))
        runs = pa.StructArray.from_arrays(
            [each.field("ts_us").take(pa.array(starts)), pa.array(stops - starts + 1)], names=["start_us", "n"]
        )
        offsets = np.r_[np.searchsorted(starts, firsts), len(starts)].astype(np.int32)
        columns = [
            batch.column("sink_key"),
            batch.column("bucket"),
            pa.ListArray.from_arrays(pa.array(offsets), runs),
            pa.array(~ok[firsts]),
            pa.array(~ok[lasts]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["sink_key", "bucket", "runs", "begins", "ends"])


def failure_streaks(
    log: DataFrame,
    threshold: int = FAILURE_THRESHOLD,
    lateness: str = "10 minutes",
    bucket_seconds: int = 10,
) -> DataFrame:
    """sink_key, streak_start, streak_len, reached_threshold and ended, of runs of failed attempts.

    A run that is over gives a row with ``ended``, the same as in batch; one that reaches the
    threshold gives a row without, at the bucket in which it does. Attempts are held back in
    buckets of time per sink until the watermark closes them, so late and unordered ones take their
    place; those later than ``lateness`` are left out. Buckets are sorted and cut into runs in
    parallel; the one task of a sink sees a row per bucket, and adds up the runs that go on.
    """
    attempt = [epoch_micros(F.col("ts")).alias("ts_us"), "event_id", "attempt", succeeded().alias("ok")]
    bucketed = (
        log.withWatermark("ts", lateness)
        .groupBy("sink_key", F.window("ts", f"{bucket_seconds} seconds"))
        .agg(F.collect_list(F.struct(*attempt)).alias("attempts"))
        .select(
            "sink_key",
            F.unix_micros(F.col("window.start").cast("timestamp")).alias("bucket"),
            F.sort_array("attempts").alias("attempts"),
        )
        .mapInArrow(_bucket_runs, _BUCKET)
    )
    schema = "sink_key string, streak_start timestamp, streak_len bigint, reached_threshold boolean, ended boolean"
    return bucketed.groupBy("sink_key").transformWithStateInPandas(_Streaks(threshold), schema, "Append", "None")
