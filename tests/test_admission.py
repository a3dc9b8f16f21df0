"""Token-bucket admission against a plain fold, with keys that span many partitions."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from remitscope.operators import admission
from remitscope.operators.admission import (
    BucketState,
    CreditMap,
    TokenBucket,
    admission_with_states,
    outcome,
    token_bucket_admission,
)

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
START_US = int(START.timestamp()) * 1_000_000


def by_hand(bucket, arrivals):
    """One bucket per key, in plain arithmetic on whole credit."""
    state, admitted = {}, {}
    for key, us, event in sorted(arrivals, key=lambda a: (str(a[0]), a[1], a[2])):
        last, credit = state.get(key, (us, bucket.full))
        credit = min(bucket.full, credit + (us - last) * bucket.gain)
        admitted[event] = credit >= bucket.token
        state[key] = (us, credit - bucket.token if admitted[event] else credit)
    return admitted


def frame(spark, arrivals, key_type="bigint"):
    rows = [(e, START + timedelta(microseconds=us), k) for k, us, e in arrivals]
    return spark.createDataFrame(rows, f"event_id bigint, ts timestamp, user_id {key_type}")


def decisions(df):
    return {r["event_id"]: r["admitted"] for r in df.collect()}


def admits(capacity, rate, seconds):
    state = BucketState(0, TokenBucket(capacity, rate).full)
    return state.admit(TokenBucket(capacity, rate), [int(s * 1_000_000) for s in seconds])


def test_burst_up_to_capacity():
    assert admits(3, 1.0, [0, 0, 0, 0]) == [True, True, True, False]


def test_refill():
    assert admits(2, 1.0, [0, 0, 0, 1, 1]) == [True, True, False, True, False]


def test_time_that_steps_back_adds_nothing():
    assert admits(1, 1.0, [5, 4, 5, 5.5, 6]) == [True, False, False, False, True]


def test_thirds_add_up():
    assert admits(1, 1 / 3, [0, 1, 2, 3]) == [True, False, False, True]


@settings(max_examples=150, deadline=None)
@given(
    capacity=st.integers(1, 4),
    rate=st.sampled_from([1.0, 0.5, 3.0, 1 / 7]),
    gaps=st.lists(st.integers(0, 3_000_000), min_size=1, max_size=40),
    share=st.floats(0, 1),
)
def test_credit_map_equals_fold_from_any_start(capacity, rate, gaps, share):
    bucket = TokenBucket(capacity, rate)
    credits = CreditMap(bucket)
    credit = int(share * bucket.full)
    state = BucketState(0, credit)
    now = 0
    for i, gap in enumerate(gaps):
        now += gap if i else 0
        credits.event(gap if i else 0)
        state.admit(bucket, [now])
    assert outcome(credits.summary(), credit) == state.credit
    if (constant := credits.constant()) is not None:
        assert constant == state.credit


def arrivals_of(seed, keys, n, spread_us):
    rng = random.Random(seed)
    # The first key holds a third of all rows, and times repeat.
    pick = lambda: keys[0] if rng.random() < 1 / 3 else rng.choice(keys)
    return [(pick(), rng.randrange(spread_us // 1000) * 1000, e) for e in range(n)]


@pytest.mark.parametrize(
    "capacity, rate, spread_s",
    [
        (1, 1.0, 5_000),  # the hot key asks for less than the refill
        (3, 1.0, 1_200),  # about as much
        (5, 1 / 3, 300),  # far more
        (2, 1 / 7200, 10),
        (40, 2.0, 600),
    ],
)
def test_hot_key_over_many_partitions(spark, capacity, rate, spread_s):
    bucket = TokenBucket(capacity, rate)
    arrivals = arrivals_of(capacity, list(range(20)), 4_000, spread_s * 1_000_000)
    found = token_bucket_admission(frame(spark, arrivals), bucket, partitions=16)
    expected = by_hand(bucket, arrivals)
    assert decisions(found) == expected
    assert len(set(expected.values())) == 2


def test_one_key_alone(spark):
    bucket = TokenBucket(2, 1.0)
    arrivals = arrivals_of(7, [1], 1_000, 700_000_000)
    found = token_bucket_admission(frame(spark, arrivals), bucket, partitions=12)
    assert decisions(found) == by_hand(bucket, arrivals)


def test_copies_of_one_event_spread_and_each_takes_a_token(spark):
    bucket = TokenBucket(3, 1.0)
    arrivals = [(1, us * 1_000_000, us) for us in range(60)] + [(1, 30_000_000, 30)] * 600
    found = token_bucket_admission(frame(spark, arrivals), bucket, partitions=8).collect()
    admitted = sorted(r["event_id"] for r in found if r["admitted"])
    # A full bucket stands before second 30; its copies use it up, and each later event finds the
    # one token of its second.
    assert admitted == sorted([*range(30), 30, 30, 30, *range(31, 60)])
    assert len(found) == len(arrivals)


def test_text_keys_and_rows_without_key(spark):
    bucket = TokenBucket(1, 1.0)
    arrivals = arrivals_of(3, ["a", "", None, "=b"], 400, 200_000_000)
    found = token_bucket_admission(frame(spark, arrivals, "string"), bucket, partitions=6)
    assert decisions(found) == by_hand(bucket, [(k if k else repr(k), u, e) for k, u, e in arrivals])
    keys = {e: k for k, _, e in arrivals}
    assert {r["event_id"]: r["user_id"] for r in found.collect()} == keys


def test_text_ids(spark):
    bucket = TokenBucket(1, 1.0)
    arrivals = [(k, us, f"event-{e:04}") for k, us, e in arrivals_of(5, [1, 2], 300, 200_000_000)]
    rows = [(e, START + timedelta(microseconds=us), k) for k, us, e in arrivals]
    events = spark.createDataFrame(rows, "event_id string, ts timestamp, user_id bigint")
    found = token_bucket_admission(events, bucket, partitions=6)
    assert decisions(found) == by_hand(bucket, arrivals)


def test_no_rows(spark):
    assert token_bucket_admission(frame(spark, []), TokenBucket(1, 1.0)).collect() == []


@pytest.mark.parametrize("capacity", [1, 3, 40])
def test_layers_of_the_credit_map_equal_a_fold_from_every_start(capacity):
    bucket = TokenBucket(capacity, 0.5)
    draw = random.Random(capacity)
    gaps = [draw.choice([0, 1, 10, 300_000, 2_000_000, 2_500_000]) for _ in range(400)]
    mapped = admission.CreditMap(bucket)
    for gap in gaps:
        mapped.event(gap)
    starts = [draw.randrange(bucket.full + 1) for _ in range(200)] + [0, bucket.full]
    for start in starts:
        state, now = admission.BucketState(0, start), 0
        times = [now := now + gap for gap in gaps]
        state.admit(bucket, times)
        assert outcome(mapped.summary(), start) == state.credit


def seconds(capacity, gaps):
    """The best time of three to feed an over-subscribed key's events to its credit map."""
    times = []
    for _ in range(3):
        mapped = CreditMap(TokenBucket(capacity, 0.5))
        began = time.perf_counter()
        for gap in gaps:
            mapped.event(gap)
        times.append(time.perf_counter() - began)
    return min(times)


def test_an_over_subscribed_key_costs_the_same_at_any_capacity():
    draw = random.Random(1)
    gaps = [draw.choice([0, 500_000, 900_000, 1_200_000]) for _ in range(20_000)]
    one = seconds(1, gaps)
    assert seconds(10_000, gaps) < 3 * one
    assert seconds(1_000_000, gaps) < 3 * one


def test_long_stretches_keep_few_pieces():
    for seed in range(40):
        draw = random.Random(seed)
        mapped = CreditMap(TokenBucket(draw.choice([1, 5, 50]), draw.choice([0.5, 1 / 7, 0.9])))
        for _ in range(2_000):
            mapped.event(draw.choice([0, 1, 700_000, 900_000, 1_100_000]))
            assert mapped.pieces is None or len(mapped.pieces) < 20


@pytest.mark.parametrize("late", [False, True])
def test_states_carry_on_from_one_part_of_the_events_to_the_next(spark, late):
    bucket = TokenBucket(4, 1 / 3)
    arrivals = arrivals_of(11, [*range(9), None], 3_000, 1_500_000_000)
    arrivals.sort(key=lambda a: (a[1], a[2]))
    parts = [arrivals[i * 750 : (i + 1) * 750] for i in range(4)]
    if late:  # some events come two parts after their time
        parts[3] += parts[1][::20]
        parts[1] = [a for i, a in enumerate(parts[1]) if i % 20]
    state, wanted, states, found = {}, {}, None, {}
    for part in parts:
        for key, us, event in sorted(part, key=lambda a: (a[1], a[2])):
            last, credit = state.get(key, (us, bucket.full))
            now = max(us, last)
            credit = min(bucket.full, credit + (now - last) * bucket.gain)
            wanted[event] = credit >= bucket.token
            state[key] = (now, credit - bucket.token if wanted[event] else credit)
        rows, states = admission_with_states(frame(spark, part), bucket, states, partitions=7)
        found |= decisions(rows)
        states = spark.createDataFrame(states.collect(), admission.STATES)
    assert found == wanted
    kept = {r["key"]: (r["last_us"] - START_US, int(r["credit"])) for r in states.collect()}
    assert kept == {("" if k is None else f"={k}"): v for k, v in state.items()}


def test_very_slow_and_very_large_buckets():
    slow = TokenBucket(1, 1 / (30 * 86_400))
    state = admission.BucketState(0, slow.full)
    month = 30 * 86_400 * 1_000_000
    assert state.admit(slow, [0, month - 1, month]) == [True, False, True]
    assert TokenBucket(1, 1e-15).gain > 0
    large = TokenBucket(2**32 - 1, 0.333333)
    assert large.full == (2**32 - 1) * large.token and large.gain * 3 < large.token
