"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR   folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_COPIES   copies of the events table, laid out one after the other in time (default 1); with
               more than one, a third of all rows goes to one user, to show the cost of skew
BENCH_RUNS     timed runs after one warm-up; the best counts (default 3)
"""

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.operators import decode
from remitscope.plans import inputs
from remitscope.plans.queries import QUERIES
from remitscope.sinks.port import FolderSink, register_sink
from remitscope.sinks.publish import BatchPublisher
from remitscope.sources import files
from remitscope.sources.port import LogSource, register_source, stream_from
from remitscope.streaming import jobs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "aggregates_snapshot",
    "enrich_events",
    "encode_enriched",
    "format_money",
    "publish_outcomes",
    "failure_streaks",
    "event_rate_1m",
    "failure_alerts",
    "stalled_intervals",
    "token_bucket_admission",
    "token_bucket_burst",
    "money_add",
    "event_rate_sliding",
]


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.local.dir", scratch)
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables(spark: SparkSession, scratch: str) -> str:
    """The folder to read: the given one, or one with more events and a hot user."""
    if COPIES == 1:
        return SF_DIR
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    n, days = events.count(), 30
    copy = F.col("copy")
    (
        events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        .withColumn("event_id", F.col("event_id") + copy * n)
        .withColumn("ts", F.col("ts") + F.make_interval(days=(copy * days).cast("int")))
        .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
        .drop("copy")
        .write.parquet(f"{scratch}/events.parquet")
    )
    return scratch


def best_time(build) -> float:
    times = []
    for _ in range(1 + RUNS):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def publish_time(spark: SparkSession, stream: Callable[[], DataFrame], scratch: str, name: str) -> float:
    """One stream from records to a sink of files, with attempt log, counters and ledger."""
    times = []
    for run in range(2):
        folder = f"{scratch}/{name}-{run}"
        publisher = BatchPublisher(FolderSink(f"{folder}/sink"), f"{folder}/out")
        start = time.perf_counter()
        jobs.run_once(stream(), publisher, f"{folder}/checkpoint")
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def sink_time(spark: SparkSession, raw: str, scratch: str) -> float:
    """One stream of enriched events into a sink behind the data source of the sink port."""
    times = []
    for run in range(2):
        folder = f"{scratch}/port-{run}"
        register_sink(spark, "bench_sink", FolderSink(f"{folder}/sink"))
        start = time.perf_counter()
        writer = jobs.enriched_events(files.stream_records(spark, raw)).writeStream.format("bench_sink")
        writer.option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        spark = session(scratch)
        sf_dir = tables(spark, scratch)

        # Records are made beforehand, so that only decoding them is timed.
        raw = f"{scratch}/raw"
        inputs.raw_records(spark, sf_dir).repartition(int(CPUS)).write.parquet(raw)

        def decoded() -> DataFrame:
            return decode.accepted(decode.decode(spark.read.parquet(raw)))

        times = {"decode_events": best_time(decoded)}
        for name in HEADLINE:
            times[name] = best_time(lambda: QUERIES[name](spark, sf_dir))
        times["stream_publish"] = publish_time(spark, lambda: files.stream_records(spark, raw), scratch, "publish")
        # The same from a log behind the data source of the source port, and into a sink behind that of its.
        spark.read.parquet(raw).repartition(1).write.parquet(f"{scratch}/log/p0")
        register_source(spark, "bench_log", LogSource(f"{scratch}/log", S.RAW_RECORD))
        port = lambda: stream_from(spark, "bench_log", rows_per_task=20_000)
        times["stream_source_port"] = publish_time(spark, port, scratch, "source")
        times["stream_sink_port"] = sink_time(spark, raw, scratch)
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        spark.stop()
    report = {
        "metric": "headline queries, total of the best times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "events_per_second": {name: round(events / seconds) for name, seconds in times.items()},
        "events": events,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "copies": COPIES,
        "cpus": int(CPUS),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
