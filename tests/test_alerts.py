"""Alerts on a stream: the rows of the batch operators, also after a restart; a silence told by the clock."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope import storage
from remitscope.operators import admission, publish_log, rates
from remitscope.operators.admission import TokenBucket
from remitscope.operators.admission import token_bucket_admission as admission_in_batch
from remitscope.sinks.port import FolderSink
from remitscope.sinks.publish import BatchPublisher
from remitscope.sources import files
from remitscope.streaming import alerts, jobs, metrics
from remitscope.streaming.admission import BatchAdmission

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def stateful(spark):
    """Few partitions, and the state store that alerts need."""
    provider, partitions = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    alerts.use_rocksdb(spark)
    spark.conf.set(partitions, "2")
    yield spark
    spark.conf.unset(provider)
    spark.conf.set(partitions, before)


def attempts(seed, seconds, late_by, n_sinks=2):
    """Attempts in the order in which they come: quiet times, bursts of failures, some rows late."""
    rng = random.Random(seed)
    rows, event = [], 0
    for second in range(0, seconds, 2):
        burst = (second // 400) % 3 == 1
        for _ in range(rng.choice([2, 3, 4]) if burst else rng.choice([0, 0, 1])):
            event += 1
            ok = rng.random() < (0.1 if burst else 0.6)
            at = START + timedelta(seconds=second, milliseconds=rng.randrange(2000))
            outcome, ms = (S.PUBLISHED, rng.choice([5, 5, 6000])) if ok else (rng.choice([S.FAILED, S.TIMED_OUT]), 5)
            rows.append((event, rng.randrange(1, 5), f"s{rng.randrange(n_sinks)}", at, outcome, ms))
    return sorted(rows, key=lambda r: r[3] + timedelta(seconds=rng.choice([0, 0, rng.random() * late_by])))


def last_rows(after):
    """One success per sink long after all others, which lets every window close."""
    at = START + timedelta(seconds=after)
    rows = [(10**6 + i, 1, f"s{i}", at, S.PUBLISHED, 1) for i in range(2)]
    return rows + [(10**7, 1, "clock", at + timedelta(days=1), S.PUBLISHED, 1)]


def write(spark, folder, rows, parts):
    for i in range(parts):
        part = spark.createDataFrame(rows[len(rows) * i // parts : len(rows) * (i + 1) // parts], S.PUBLISH_ATTEMPT)
        part.coalesce(1).write.mode("append").parquet(folder)


def drain(stream, out, checkpoint):
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = query.start(out)
    query.awaitTermination()
    assert query.exception() is None


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def stream_of(spark, folder, schema=S.PUBLISH_ATTEMPT):
    return files.stream_records(spark, folder, 1, schema)


def test_failure_alerts_equal_batch_across_a_restart(stateful, tmp_path):
    spark, folder = stateful, str(tmp_path / "log")
    rows = attempts(3, 4_000, 60)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    options = {"threshold": 0.5, "hold_seconds": 120, "seconds": 60, "step": 10}

    def alert():
        failed = F.col("outcome") == S.FAILED
        return alerts.rate_alerts(stream_of(spark, folder), failed, lateness="2 minutes", **options)

    write(spark, folder, rows[: len(rows) // 2], 3)
    drain(alert(), out, checkpoint)
    write(spark, folder, rows[len(rows) // 2 :], 3)
    write(spark, folder, last_rows(4_100), 2)
    drain(alert(), out, checkpoint)
    log = spark.createDataFrame(rows, S.PUBLISH_ATTEMPT)
    wanted = as_rows(rates.rate_alerts(log.where(F.col("outcome") == S.FAILED), **options))
    found = spark.read.parquet(out)
    resolved = found.where("state = 'resolved'").select("start", "end", "evaluations")
    assert len(wanted) >= 3 and as_rows(resolved) == wanted
    firing = found.where("state = 'firing'")
    assert {r["start"] for r in firing.collect()} == {r[0] for r in wanted}
    assert all((r["end"] - r["start"]).total_seconds() == 120 for r in firing.collect())
    pending, dropped = found.where("state = 'pending'").count(), found.where("state = 'dropped'").count()
    assert pending == len(wanted) + dropped


def test_an_alert_is_resolved_by_time_alone(stateful, tmp_path):
    """No failure ever comes again; only the clock of the log goes on."""
    spark, folder = stateful, str(tmp_path / "log")
    rows = [(i, 1, "s", START + timedelta(seconds=i), S.FAILED, 1) for i in range(100)]
    write(spark, folder, rows, 1)
    write(spark, folder, [(1000, 1, "s", START + timedelta(hours=1), S.PUBLISHED, 1)], 1)
    write(spark, folder, [(1001, 1, "s", START + timedelta(hours=2), S.PUBLISHED, 1)], 1)
    failed = F.col("outcome") == S.FAILED
    stream = alerts.rate_alerts(stream_of(spark, folder), failed, 0.5, 30, 60, 10, lateness="0 seconds")
    drain(stream, str(tmp_path / "out"), str(tmp_path / "c"))
    found = [(r["state"], int((r["start"] - r["end"]).total_seconds())) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(state for state, _ in found) == ["firing", "pending", "resolved"]
    with pytest.raises(ValueError, match="multiple"):
        alerts.rate_alerts(stream_of(spark, folder), failed, 0.5, 30, 61, 10)


def test_failure_streaks_equal_batch_with_late_attempts_and_a_restart(stateful, tmp_path):
    spark, folder = stateful, str(tmp_path / "log")
    rows = attempts(8, 3_000, 100)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def streaks():
        return alerts.failure_streaks(stream_of(spark, folder), 4, lateness="2 minutes", bucket_seconds=7)

    write(spark, folder, rows[: len(rows) // 3], 2)
    drain(streaks(), out, checkpoint)
    write(spark, folder, rows[len(rows) // 3 :], 3)
    write(spark, folder, last_rows(3_200), 2)
    drain(streaks(), out, checkpoint)
    log = spark.createDataFrame(rows, S.PUBLISH_ATTEMPT)
    wanted = as_rows(publish_log.failure_streaks(log, 4))
    found = spark.read.parquet(out)
    columns = ["sink_key", "streak_start", "streak_len", "reached_threshold"]
    assert max(r[2] for r in wanted) > 20
    assert as_rows(found.where("ended").select(columns)) == wanted
    told = found.where("NOT ended")
    assert {(r["sink_key"], r["streak_start"]) for r in told.collect()} <= {r[:2] for r in wanted if r[3]}
    assert told.count() == told.select("sink_key", "streak_start").distinct().count() > 0


def test_runs_of_a_bucket_equal_a_plain_loop():
    rng = random.Random(2)
    rows = [[(i, rng.random() < 0.5) for i in range(rng.randrange(1, 9))] for _ in range(200)]
    kind = pa.list_(pa.struct([("ts_us", pa.int64()), ("event_id", pa.int64()), ("attempt", pa.int32()), ("ok", pa.bool_())]))
    lists = [[{"ts_us": us, "event_id": 0, "attempt": 0, "ok": ok} for us, ok in row] for row in rows]
    batch = pa.record_batch(
        [pa.array(["s"] * 200), pa.array(np.arange(200)), pa.array(lists, kind)], names=["sink_key", "bucket", "attempts"]
    )
    found = [r for b in alerts._bucket_runs(iter([batch.slice(0, 77), batch.slice(77)])) for r in b.to_pylist()]
    for row, got in zip(rows, found):
        runs, failing = [], False
        for us, ok in row:
            if not ok and not failing:
                runs.append({"start_us": us, "n": 0})
            if not ok:
                runs[-1]["n"] += 1
            failing = not ok
        assert got["runs"] == runs and got["begins"] == (not row[0][1]) and got["ends"] == (not row[-1][1])


def test_a_silent_source_is_one_stall_closed_by_the_next_event(stateful, tmp_path):
    spark, folder = stateful, str(tmp_path / "events")

    def add(*seconds):
        rows = [(START + timedelta(seconds=s),) for s in seconds]
        spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.mode("append").parquet(folder)

    add(1, 2, 3)
    stream = alerts.stalls(files.stream_records(spark, folder, 10, "ts timestamp"), silence_seconds=3)
    query = stream.writeStream.format("memory").queryName("stalls").option("checkpointLocation", str(tmp_path / "c"))
    query = query.trigger(processingTime="200 milliseconds").start()

    def wait_for(n):
        deadline = datetime.now() + timedelta(seconds=60)
        while spark.table("stalls").count() < n and datetime.now() < deadline:
            assert query.exception() is None
            query.awaitTermination(0.3)
        return [tuple(r) for r in spark.table("stalls").orderBy("last_ts", F.desc("state")).collect()]

    try:
        (stall,) = wait_for(1)
        assert stall[0] == "stalled" and stall[1].second == 3 and stall[2] is None and stall[3] >= 3000
        query.awaitTermination(4)
        assert spark.table("stalls").count() == 1  # one silence, one stall
        add(50, 60)
        rows = wait_for(2)
        assert [r[0] for r in rows] == ["stalled", "resumed"]
        assert (rows[1][1].second, rows[1][2].second) == (3, 50) and rows[1][3] >= 6000
        again = wait_for(3)
        assert again[2][0] == "stalled" and again[2][1].minute == 1
    finally:
        query.stop()


def test_a_listener_keeps_exact_totals_without_a_job_of_its_own(spark, tmp_path):
    from remitscope.plans import inputs

    topic = str(tmp_path / "topic")
    records = inputs.raw_records(spark, "/root/testdata/sf0.001")
    records.repartition(12).write.parquet(topic)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    listener = metrics.MetricsListener(spark, str(tmp_path / "totals"))
    spark.streams.addListener(listener)
    try:
        assert metrics.observed_totals(spark, str(tmp_path / "totals")).count() == 0
        query = jobs.start_read_model(files.stream_records(spark, topic, 1), str(tmp_path / "model"), str(tmp_path / "c"))
        query.awaitTermination()
        deadline = datetime.now() + timedelta(seconds=30)
        row = None
        while (row is None or row["batches"] < 12) and datetime.now() < deadline:
            row = metrics.observed_totals(spark, str(tmp_path / "totals")).first()
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set(kept, before)
    assert (row["query_id"], row["consumed"], row["rejected"], row["batches"]) == (str(query.id), 740, 240, 12)
    assert len(query.recentProgress) <= 2


def test_the_publisher_counts_without_reading_a_batch_twice(spark, tmp_path):
    from remitscope.plans import inputs

    topic = str(tmp_path / "topic")
    inputs.raw_records(spark, "/root/testdata/sf0.001").repartition(3).write.parquet(topic)
    publisher = BatchPublisher(FolderSink(str(tmp_path / "sink")), str(tmp_path / "out"))
    jobs.run_once(files.stream_records(spark, topic, 1), publisher, str(tmp_path / "c"))
    totals = jobs.reported(spark, str(tmp_path / "out"))
    assert (totals["consumed"], totals["rejected"], totals["published"]) == (740, 240, 740)


def test_a_hot_key_on_the_stream_equals_batch_and_is_spread(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(4_000):
        user = 0 if rng.random() < 0.5 else rng.randrange(1, 30)
        rows.append((i, user, START + timedelta(milliseconds=100 * i + rng.randrange(100))))
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    schema = "event_id bigint, user_id bigint, ts timestamp"
    for i in range(3):
        part = spark.createDataFrame(rows[i * 4_000 // 3 : (i + 1) * 4_000 // 3], schema)
        part.coalesce(1).write.mode("append").parquet(folder)
    bucket = TokenBucket(20, 2.0)
    folds = []

    def written(df, name, *by):
        table = storage.written(df, name, *by)
        if name == "admission":
            folds.append(table)
        return table

    monkeypatch.setattr(admission, "written", written)

    def write_batch(decisions, batch_id):
        decisions.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run():
        decide = BatchAdmission(bucket, write_batch, str(tmp_path / "buckets"), partitions=16)
        stream = files.stream_records(spark, folder, 1, schema)
        query = stream.writeStream.foreachBatch(decide).option("checkpointLocation", str(tmp_path / "c"))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None

    run()
    more = [(10_000 + i, i % 3, START + timedelta(seconds=1000 + i)) for i in range(60)]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    columns = ["event_id", "user_id", "admitted"]
    expected = admission_in_batch(spark.createDataFrame(rows + more, schema), bucket).select(columns)
    found = spark.read.parquet(out).select(columns)
    assert as_rows(found) == as_rows(expected)
    assert {r["admitted"] for r in found.collect()} == {True, False}
    # A micro-batch has 1,333 rows, half of them of one key: no task folds more than its share.
    for fold in folds[:3]:
        events = fold.where("kind IN (0, 1)")
        of_key = events.where("key = '=0'").groupBy("block").count().agg(F.count("*"), F.sum("count")).first()
        assert of_key[0] >= 6 and of_key[1] > 600
        assert events.groupBy("block").count().agg(F.max("count")).first()[0] < 1333 / 16 * 2
    # Buckets that are full again are forgotten: those of before the long pause are.
    assert spark.read.parquet(*[str(p) for p in (tmp_path / "buckets").glob("*/batch_id=3")]).count() <= 3
