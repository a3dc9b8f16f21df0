"""Rates, alerts and stalls against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from remitscope.operators import rates

EPOCH = datetime(1970, 1, 1)
START = datetime(2026, 1, 1)


def rows(spark, seconds):
    return spark.createDataFrame([(START + timedelta(seconds=s),) for s in seconds], "ts timestamp")


def test_rate_per_minute(spark):
    found = rates.event_rate(rows(spark, [0, 59.999999, 60, 200])).orderBy("window_start").collect()
    assert [(r["window_start"], r["n"], r["per_second"]) for r in found] == [
        (START, 2, 2 / 60),
        (START + timedelta(seconds=60), 1, 1 / 60),
        (START + timedelta(seconds=180), 1, 1 / 60),
    ]


def test_sliding_rate_counts_each_row_in_each_window(spark):
    found = rates.sliding_rate(rows(spark, [5])).collect()
    assert sorted((r["window_start"] - START).total_seconds() for r in found) == [
        -50, -40, -30, -20, -10, 0,
    ]


def test_window_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(ValueError):
        rates.sliding_rate(rows(spark, [5]), seconds=60, step=7)


def test_times_before_1970(spark):
    frame = spark.createDataFrame([(EPOCH - timedelta(seconds=1),)], "ts timestamp")
    assert rates.event_rate(frame).first()["window_start"] == EPOCH - timedelta(seconds=60)


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_runs_of_integers(spark, block):
    rng = random.Random(block)
    numbers = sorted(rng.sample(range(-150, 150), 200))
    expected = []
    for n in numbers:
        if expected and expected[-1][1] == n - 1:
            expected[-1] = (expected[-1][0], n, expected[-1][2] + 1)
        else:
            expected.append((n, n, 1))
    frame = spark.createDataFrame([(n, n) for n in numbers], "first bigint, last bigint")
    found = rates.joined_runs(frame, block).collect()
    assert sorted((r["first"], r["last"], r["ticks"]) for r in found) == expected


@pytest.mark.parametrize("block", [6, 7, 50, 8640])
def test_levels_equal_the_sliding_counts(spark, block):
    rng = random.Random(block)
    frame = rows(spark, [rng.randrange(6_000) + rng.choice([0, 86_000]) for _ in range(300)])
    expected = {
        r["window_start"]: r["n"] for r in rates.sliding_rate(frame, seconds=60, step=10).collect()
    }
    found = {}
    for r in rates.sliding_levels(frame, 60, 10, block).collect():
        for tick in range(r["first"], r["last"] + 1):
            if r["n"]:
                found[EPOCH + timedelta(seconds=tick * 10 - 60)] = r["n"]
    assert found == expected


def test_alert_fires_only_when_held(spark):
    # Two rows per second for 400 s, up to and over midnight; then a burst too short to count.
    midnight = 86_400
    steady = [midnight - 300 + i / 2 for i in range(800)]
    burst = [midnight + 5_000 + i / 1000 for i in range(400)]
    found = rates.rate_alerts(rows(spark, steady + burst), threshold=1.0).collect()
    [alert] = found
    # Above one per second once more than 300 rows lie in the last 300 s, and until they do not.
    assert alert["start"] == START + timedelta(seconds=midnight - 300 + 160)
    assert alert["end"] == START + timedelta(seconds=midnight + 240)
    assert alert["evaluations"] == 39  # 380 s in steps of 10 s, both ends included
    # The burst stays in the window for 30 evaluations, which span 290 s: not held for 300 s.


def test_stalled(spark):
    day = 86_400
    seconds = [0, 899, 1799, 1800, 5 * day, 5 * day + 900, 5 * day + 900]
    found = rates.stalled_intervals(rows(spark, seconds)).orderBy("last_ts").collect()
    assert [(r["last_ts"] - START).total_seconds() for r in found] == [899, 1800, 5 * day]
    assert [r["gap_ms"] for r in found] == [900_000, (5 * day - 1800) * 1000, 900_000]


@pytest.mark.parametrize("silence", [1, 60, 900, 200_000])
def test_stalled_against_sorted_list(spark, silence):
    rng = random.Random(silence)
    seconds, now = [], 0
    for _ in range(600):
        now += rng.choice([0, 1, 59, 60, 61, 900, 5_000, 90_000, 250_000])
        seconds.append(now)
    expected = [(a, b) for a, b in zip(seconds, seconds[1:]) if b - a >= silence]
    found = rates.stalled_intervals(rows(spark, seconds), silence_seconds=silence).collect()
    pairs = [
        ((r["last_ts"] - START).total_seconds(), (r["next_ts"] - START).total_seconds())
        for r in found
    ]
    assert sorted(pairs) == expected


def test_a_stall_that_goes_on_ends_with_the_given_moment(spark):
    moment = F.to_timestamp(F.lit("2024-01-01 02:00:00"))
    one = spark.createDataFrame([(datetime(2024, 1, 1, 1),)], "ts timestamp")
    assert [tuple(r) for r in rates.stalled_intervals(one, as_of=moment).collect()] == [
        (datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2), 3_600_000)
    ]
    assert rates.stalled_intervals(one).count() == 0
    (row,) = rates.stalled_intervals(one.limit(0), as_of=moment).collect()
    assert tuple(row) == (None, datetime(2024, 1, 1, 2), None)
    before = F.to_timestamp(F.lit("2024-01-01 00:30:00"))
    assert rates.stalled_intervals(one, as_of=before).count() == 0
