"""Sources and sinks as ports of Python data sources: bounds, restarts, commits and aborts."""

import sys
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitscope import schema as S
from remitscope.config import RetryPolicy
from remitscope.operators import decode
from remitscope.plans import inputs
from remitscope.sinks.port import EventSink, FolderSink, RecordingSink, read_committed, register_sink
from remitscope.sources import port
from remitscope.sources.port import EventSource, LogSource, bounded, ranges, register_source, stream_from

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks cannot import the tests

SF_DIR = "/root/testdata/sf0.001"
AT_ONCE = RetryPolicy(max_attempts=2, initial_backoff=0.0)
NUMBERS = T.StructType().add("p", T.StringType()).add("n", T.LongType())


def test_a_fetch_is_bounded_and_shared_out():
    assert bounded({"a": 5}, {"a": 25, "b": 10}, None) == {"a": 25, "b": 10}
    assert bounded({"a": 5}, {"a": 25, "b": 10}, 30) == {"a": 25, "b": 10}
    assert bounded({"a": 5}, {"a": 25, "b": 10}, 9) == {"a": 11, "b": 3}
    assert bounded({"a": 5, "b": 9}, {"a": 5, "b": 10}, 1) == {"a": 5, "b": 10}
    for most in range(1, 12):
        at, end, steps = {}, {"a": 7, "b": 2, "c": 0}, 0
        while at != end:
            new = bounded(at, end, most)
            assert 0 < sum(new.values()) - sum(at.values()) <= most
            at, steps = new, steps + 1
        assert steps == -(-9 // most)


def test_ranges_cover_each_offset_once():
    found = ranges({"a": 3}, {"a": 10, "b": 4, "c": 0}, 3)
    assert [(r.partition, r.start, r.end) for r in found] == [
        *[("a", 3, 5), ("a", 5, 7), ("a", 7, 10)],
        *[("b", 0, 2), ("b", 2, 4)],
    ]
    with pytest.raises(ValueError, match="goes back"):
        ranges({"a": 3}, {"a": 2}, 10)


@pytest.fixture
def log(spark, tmp_path):
    """A log of raw records in two partitions, three files each, and how to add a file."""
    folder = tmp_path / "log"
    records = inputs.raw_records(spark, SF_DIR).orderBy("offset").collect()

    def add(partition, name, rows):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        (folder / partition).mkdir(parents=True, exist_ok=True)
        made = pa.Table.from_pylist([r.asDict() for r in rows], to_arrow_schema(S.RAW_RECORD))
        pq.write_table(made, folder / partition / f"{name}.parquet", row_group_size=40)

    for i in range(6):
        add(f"p{i % 2}", f"{i:03}", records[i * 100 : (i + 1) * 100])
    return str(folder), add, records


def offsets(df):
    return sorted(r["offset"] for r in df.select("offset").collect())


def test_a_log_is_read_in_batch(spark, log):
    folder, _, records = log
    register_source(spark, "log_batch", LogSource(folder, S.RAW_RECORD))
    for rows_per_task in (1_000_000, 35):
        found = spark.read.format("log_batch").option("rowsPerTask", rows_per_task).load()
        assert found.schema == S.RAW_RECORD
        assert offsets(found) == sorted(r["offset"] for r in records[:600])
    assert decode.decode(found).where("reject_reason IS NULL").count() > 300


def run(stream, folder, trigger, until=None):
    """Runs a stream into files until it has seen so many rows."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(**trigger)
    query = writer.start(f"{folder}/out")
    try:
        if until is None:
            query.awaitTermination(120)
        else:
            deadline = datetime.now() + timedelta(seconds=90)
            while sum(p.numInputRows for p in query.recentProgress) < until and datetime.now() < deadline:
                query.awaitTermination(0.2)
        assert query.exception() is None
        return [p.numInputRows for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()


def test_a_stream_goes_on_where_it_stopped(spark, log, tmp_path):
    folder, add, records = log
    register_source(spark, "log_all", LogSource(folder, S.RAW_RECORD))
    for i in range(2):
        run(stream_from(spark, "log_all", rows_per_task=64), tmp_path, {"availableNow": True})
        assert offsets(spark.read.parquet(str(tmp_path / "out"))) == sorted(r["offset"] for r in records[: 600 + 100 * i])
        add("p1", f"9{i}", records[600 + 100 * i : 700 + 100 * i])


def test_a_bounded_stream_restarted_in_mid_stream_loses_and_repeats_nothing(spark, log, tmp_path):
    folder, add, records = log
    register_source(spark, "log_some", LogSource(folder, S.RAW_RECORD))
    trigger = {"processingTime": "100 milliseconds"}
    first = run(stream_from(spark, "log_some", 70), tmp_path, trigger, until=200)
    assert len(first) >= 3 and max(first) <= 70
    found = offsets(spark.read.parquet(str(tmp_path / "out")))
    assert len(found) == len(set(found)) < 600
    add("p0", "900", records[600:650])
    second = run(stream_from(spark, "log_some", 70), tmp_path, trigger, until=650 - len(found))
    assert max(second) <= 70
    assert offsets(spark.read.parquet(str(tmp_path / "out"))) == sorted(r["offset"] for r in records[:650])


class Counting(EventSource):
    """Numbers from 10 on, in a partition each; notes what it is told to have been processed."""

    def __init__(self, notes):
        self.notes = notes

    def schema(self):
        return NUMBERS

    def begin(self):
        return {"x": 10, "y": 10}

    def end(self):
        return {"x": 40, "y": 10, "z": 5}

    def fetch(self, partition, start, end):
        yield pa.record_batch({"p": [partition] * (end - start), "n": list(range(start, end))})

    def processed(self, end):
        with open(self.notes, "a") as out:
            out.write(f"{sorted(end.items())}\n")


def test_a_source_of_ones_own(spark, tmp_path):
    register_source(spark, "counting", Counting(str(tmp_path / "notes")))
    wanted = sorted([("x", n) for n in range(10, 40)] + [("z", n) for n in range(5)])
    assert sorted(map(tuple, spark.read.format("counting").load().collect())) == wanted
    sizes = run(stream_from(spark, "counting", 8), tmp_path, {"processingTime": "0 seconds"}, until=35)
    assert sum(sizes) == 35 and max(sizes) <= 8
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == wanted
    assert "('x', 10)" in (tmp_path / "notes").read_text()


def numbers_stream(spark, tmp_path, n=60, files=3):
    folder = str(tmp_path / "numbers")
    for i in range(files):
        spark.range(i * n, (i + 1) * n, 1, 2).select(F.col("id").alias("n")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("n bigint").option("maxFilesPerTrigger", 1).parquet(folder)


def start(stream, name, checkpoint, run="r"):
    writer = stream.writeStream.format(name).option("checkpointLocation", str(checkpoint)).option("run", run)
    return writer.trigger(availableNow=True).start()


def numbers(df):
    return sorted(r["n"] for r in df.collect())


def test_a_folder_sink_shows_committed_batches(spark, tmp_path):
    sink = FolderSink(str(tmp_path / "sink"))
    register_sink(spark, "folder_sink", sink)
    query = start(numbers_stream(spark, tmp_path), "folder_sink", tmp_path / "c")
    query.awaitTermination()
    assert query.exception() is None
    assert numbers(read_committed(spark, sink, "n bigint")) == list(range(180))
    assert len(list((tmp_path / "sink" / "committed").glob("*.json"))) == 3
    sink.commit("r-2", [])  # the same batch once more changes nothing
    assert numbers(read_committed(spark, sink, "n bigint")) == list(range(180))


def test_an_aborted_batch_leaves_nothing_and_its_replay_all(spark, tmp_path):
    trouble = tmp_path / "trouble"
    trouble.write_text("")

    def fails(event, before):
        import os

        return event["n"] == 100 and os.path.exists(str(trouble))

    sink = RecordingSink(str(tmp_path / "sink"), fails)
    register_sink(spark, "recording_sink", sink, AT_ONCE)
    stream = numbers_stream(spark, tmp_path)
    query = start(stream, "recording_sink", tmp_path / "c")
    with pytest.raises(Exception, match="sink refused the event"):
        query.awaitTermination()
    assert numbers(read_committed(spark, sink, "n bigint")) == list(range(60))
    trouble.unlink()
    query = start(stream, "recording_sink", tmp_path / "c")
    query.awaitTermination()
    assert numbers(read_committed(spark, sink, "n bigint")) == list(range(180))


def test_first_attempts_that_fail_are_made_again(spark, tmp_path):
    sink = RecordingSink(str(tmp_path / "sink"), lambda event, before: before < 1)
    register_sink(spark, "flaky_sink", sink, AT_ONCE)
    query = start(numbers_stream(spark, tmp_path, files=1), "flaky_sink", tmp_path / "c")
    query.awaitTermination()
    assert numbers(read_committed(spark, sink, "n bigint")) == list(range(60))


def test_commit_and_abort_of_a_folder_sink(spark, tmp_path):
    sink = FolderSink(str(tmp_path / "sink"))
    messages = []
    for i in range(3):
        sink.open()
        sink.publish({"n": i, "at": datetime(2026, 1, 1), "raw": b"\x01", "text": 'é"\n'})
        messages.append(sink.flush())
        sink.close()
    sink.open()
    messages.append(sink.flush())  # a task without events
    sink.abort("a", messages[:1])
    assert sink.committed() == [] and not (tmp_path / "sink" / messages[0]["path"]).exists()
    sink.commit("b", messages[1:])
    found = read_committed(spark, sink, "n bigint, at timestamp, raw string, text string").orderBy("n").collect()
    assert [tuple(r) for r in found] == [(i, datetime(2026, 1, 1), "01", 'é"\n') for i in (1, 2)]
    assert len(sink.committed()) == 2


def test_a_port_needs_its_methods():
    with pytest.raises(TypeError):
        EventSink()
    with pytest.raises(TypeError):
        EventSource()
    reader = port._StreamReader(Counting("none"), 5, 10)
    assert reader.initialOffset() == reader.latestOffset() == {"x": 10, "y": 10, "z": 0}
