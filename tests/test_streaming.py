"""Streams over files: the same answers as in batch, also across restarts and failures."""

from datetime import datetime, timedelta
from threading import Event, Thread

import pytest
from pyspark.sql import functions as F

from remitscope.operators import aggregates, decode, rates
from remitscope.operators.admission import TokenBucket
from remitscope.operators.admission import token_bucket_admission as admission_in_batch
from remitscope.operators.enrich import enrich
from remitscope.plans import inputs
from remitscope.sinks.port import FolderSink, read_committed
from remitscope.sinks.publish import BatchPublisher, read_ledger
from remitscope.sinks.snapshot import SnapshotWriter, read_snapshot
from remitscope.sources import files
from remitscope.streaming import jobs
from remitscope.streaming import rates as stream_rates
from remitscope.streaming.admission import token_bucket_admission

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """The raw records as four files in order of their offsets."""
    folder = str(tmp_path_factory.mktemp("topic"))
    records = inputs.raw_records(spark, SF_DIR)
    for i in range(4):
        part = records.where((F.col("offset") >= i * 250) & (F.col("offset") < (i + 1) * 250))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.fixture(scope="module")
def good(spark, topic):
    return decode.events_only(decode.decode(files.read_records(spark, topic)))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_read_model_equals_batch_and_survives_a_restart(spark, topic, good, tmp_path):
    folder, checkpoint = str(tmp_path / "model"), str(tmp_path / "checkpoint")
    stream = files.stream_records(spark, topic, max_files=1)
    query = finish(jobs.start_read_model(stream, folder, checkpoint))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4

    expected = aggregates.snapshot(enrich(good)).orderBy("dimension", "key").collect()
    columns = ["dimension", "key", "n", "settled_minor_units", "max_risk_score"]

    def found():
        return read_snapshot(spark, folder).select(*columns).orderBy("dimension", "key").collect()

    assert found() == expected
    # Nothing new to read: the restarted query leaves the model as it is.
    finish(jobs.start_read_model(stream, folder, checkpoint))
    assert found() == expected


def test_snapshots_of_a_new_run_replace_those_of_an_old_one(spark, topic, good, tmp_path):
    folder = str(tmp_path / "model")
    partials = aggregates.partial_aggregates(enrich(good))
    SnapshotWriter(folder)(partials, 1000)
    SnapshotWriter(folder)(partials.limit(0), 1)

    def total():
        return read_snapshot(spark, folder).where("dimension = 'total'").first()["n"]

    assert total() == 0
    held = read_snapshot(spark, folder)
    writer = SnapshotWriter(folder)
    for batch_id in range(2, 22):
        writer(partials, batch_id)
    assert held.where("dimension = 'total'").first()["n"] == 0
    assert total() == good.count()
    SnapshotWriter(folder, keep_seconds=0)(partials, 22)
    assert len(list((tmp_path / "model" / "snapshots").iterdir())) == 1
    assert total() == good.count()
    with pytest.raises(Exception, match="(?i)does not exist|not.?found"):
        held.collect()
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        read_snapshot(spark, str(tmp_path / "nothing"))


def test_a_new_checkpoint_on_an_old_folder_publishes_again(spark, topic, tmp_path):
    for run in ("first", "second"):
        sink = FolderSink(str(tmp_path / run))
        publisher = BatchPublisher(sink, str(tmp_path / "out"))
        stream = files.stream_records(spark, topic, max_files=1)
        assert jobs.run_once(stream, publisher, str(tmp_path / f"checkpoint-{run}")) == 740
        assert read_committed(spark, sink, "payment_id string").count() == 740
        assert jobs.run_once(stream, publisher, str(tmp_path / f"checkpoint-{run}")) == 0
    ledger = read_ledger(spark, str(tmp_path / "out"))
    assert ledger.select("query_id").distinct().count() == 2


def test_totals_cover_more_batches_than_spark_keeps_progress_for(spark, topic, tmp_path):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        publisher = BatchPublisher(FolderSink(str(tmp_path / "sink")), str(tmp_path / "out"))
        stream = files.stream_records(spark, topic, max_files=1)
        finish(jobs.start_publish(stream, publisher, str(tmp_path / "checkpoint")))
    finally:
        spark.conf.set(kept, before)
    assert jobs.reported(spark, str(tmp_path / "out")) == {
        "consumed": 740,
        "rejected": 240,
        "published": 740,
        "publish_failed": 0,
    }


def test_quarantine(spark, topic, tmp_path):
    folder = str(tmp_path / "quarantine")
    stream = files.stream_records(spark, topic)
    finish(jobs.start_quarantine(stream, folder, str(tmp_path / "checkpoint")))
    found = spark.read.parquet(folder)
    expected = decode.rejected(decode.decode(files.read_records(spark, topic)))
    names = ["topic", "partition", "offset", "value", "reject_reason"]
    assert as_rows(found.select(names)) == as_rows(expected.select(names))
    assert found.count() == 240


def test_failed_query_starts_again_until_stopped(spark, topic, tmp_path):
    stop, starts = Event(), []
    sink = FolderSink(str(tmp_path / "sink"))

    def start():
        starts.append(1)
        if len(starts) == 1:
            raise RuntimeError("no broker")
        publisher = BatchPublisher(sink, str(tmp_path / "out"))
        stream = files.stream_records(spark, topic, max_files=2)
        trigger = {"processingTime": "200 milliseconds"}
        return jobs.start_publish(stream, publisher, str(tmp_path / "checkpoint"), trigger)

    runner = Thread(target=jobs.run_until, args=(stop, start, 0.1))
    runner.start()
    last_rows = "ledger/query_id=*/batch_id=1/_SUCCESS"
    deadline = datetime.now() + timedelta(seconds=60)
    while not list((tmp_path / "out").glob(last_rows)) and datetime.now() < deadline:
        Event().wait(0.2)
    stop.set()
    runner.join(timeout=60)
    assert not runner.is_alive()
    assert len(starts) == 2 and read_committed(spark, sink, "payment_id string").count() == 740


def test_json_lines_reach_the_decoder(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"payment_id": 5}\nnot json\n')
    found = decode.decode(files.read_json_lines(spark, str(tmp_path / "lines.json"))).collect()
    assert [r["reject_reason"] for r in found] == ["missing_field", "malformed"]


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events"))
    events = inputs.read_events(spark, SF_DIR)
    for i in range(4):
        part = events.where((F.col("event_id") >= i * 250) & (F.col("event_id") < (i + 1) * 250))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder, events.schema


def to_memory(df, name, checkpoint):
    query = df.writeStream.format("memory").queryName(name).trigger(availableNow=True)
    finish(query.option("checkpointLocation", checkpoint).start())


@pytest.mark.parametrize("capacity, rate", [(1, 1 / 36_000), (3, 1 / 72_000)])
def test_admission_equals_batch(spark, event_files, tmp_path, capacity, rate):
    folder, schema = event_files
    bucket = TokenBucket(capacity, rate)
    name = f"admitted_{capacity}"
    stream = files.stream_records(spark, folder, 1, schema)
    to_memory(token_bucket_admission(stream, bucket), name, str(tmp_path / "c"))
    columns = ["event_id", "user_id", "admitted"]
    expected = admission_in_batch(spark.read.parquet(folder), bucket).select(columns)
    found = spark.table(name).select(columns)
    assert as_rows(found) == as_rows(expected)
    assert {r["admitted"] for r in found.collect()} == {True, False}


def test_admission_on_the_wall_clock(spark, event_files, tmp_path):
    folder, schema = event_files
    stream = files.stream_records(spark, folder, 10, schema)
    bucket = TokenBucket(2, 1 / 3600)
    admitted = token_bucket_admission(stream, bucket, now=F.current_timestamp())
    to_memory(admitted, "admitted_now", str(tmp_path / "c"))
    # All events of the one batch arrive at the same time, so a key gets its burst and no more.
    per_key = spark.table("admitted_now").groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if("admitted").alias("yes")
    )
    assert per_key.where("yes <> least(n, 2)").count() == 0


def test_rate_equals_batch(spark, event_files, tmp_path):
    folder, schema = event_files
    stream = files.stream_records(spark, folder, 1, schema)
    to_memory(stream_rates.event_rate(stream), "rate_1m", str(tmp_path / "c"))
    expected = rates.event_rate(spark.read.parquet(folder))
    # Windows that the watermark has not passed yet are still open.
    closed = spark.table("rate_1m")
    last = closed.agg(F.max("window_start")).first()[0]
    assert as_rows(closed) == as_rows(expected.where(F.col("window_start") <= F.lit(last)))
    assert expected.count() - closed.count() <= 2


def test_state_of_idle_keys_goes_and_a_hot_key_is_as_in_batch(spark, tmp_path):
    folder = str(tmp_path / "events")
    start = datetime(2024, 1, 1)
    days = [[(i, i % 40, start + timedelta(seconds=i)) for i in range(200)]]
    for day in range(1, 4):
        days.append([(1000 * day + i, 0, start + timedelta(days=day, seconds=7 * i)) for i in range(90)])
    for rows in days:
        part = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp")
        part.coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    bucket = TokenBucket(3, 1 / 60)
    stream = files.stream_records(spark, folder, 1, schema)
    admitted = token_bucket_admission(stream, bucket, lateness="1 minute")
    query = admitted.writeStream.format("memory").queryName("admitted_idle").trigger(availableNow=True)
    query = finish(query.option("checkpointLocation", str(tmp_path / "c")).start())
    expected = admission_in_batch(spark.read.parquet(folder), bucket)
    columns = ["event_id", "user_id", "admitted"]
    assert as_rows(spark.table("admitted_idle").select(columns)) == as_rows(expected.select(columns))
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) == 40 and kept[-1] <= 1
