"""Token-bucket admission per key: which events a rate limit lets through.

A bucket starts full, refills evenly up to its capacity, and an event that finds a whole token
takes it. The decision on an event depends on all earlier ones of its key. To keep a key that
holds a third of all rows off a single task, the rows are range-partitioned on (key, time, id), and
each partition is folded without knowing how full the bucket was where it begins:

Copies of one event spread by their place in the input.

1. Only the first key of a partition can reach back into an earlier one. For that key the fold
   carries the credit as a function of the unknown credit at the start (:class:`CreditMap`).
   Once the function has become constant, which any long enough pause brings about, decisions
   are final again; the rows before that point stay open.
2. The functions, one per partition, are chained by key, which gives each start its credit.
3. The open rows are folded again from there.

Credit is counted in integers, so the cuts between partitions and micro-batches cannot change a
decision by rounding.
"""

import json
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitscope.functions.times import epoch_micros
from remitscope.storage import written

# Lowest and highest place, lowest and highest start.
Piece = tuple[int, int, int, int]


@dataclass(frozen=True)
class TokenBucket:
    """Capacity in tokens and refill rate.

    The rate is taken as the simplest fraction that is the same float, however small it is.
    """

    capacity: int
    refill_per_sec: float

    @cached_property
    def _rate(self) -> Fraction:
        exact = Fraction(self.refill_per_sec)
        digits = 6
        while (simple := exact.limit_denominator(10**digits)) != exact:
            if float(simple) == self.refill_per_sec:
                return simple
            digits += 1
        return exact

    @cached_property
    def gain(self) -> int:
        """Credit per elapsed microsecond."""
        return self._rate.numerator

    @cached_property
    def token(self) -> int:
        """Credit that one event takes."""
        return 1_000_000 * self._rate.denominator

    @cached_property
    def full(self) -> int:
        return self.capacity * self.token


@dataclass
class BucketState:
    """Credit as of the latest time seen. Time that steps back adds nothing."""

    last_us: int
    credit: int

    def admit(self, bucket: TokenBucket, times_us: Iterable[int]) -> list[bool]:
        gain, token, full = bucket.gain, bucket.token, bucket.full
        last, credit = self.last_us, self.credit
        decisions = []
        for now in times_us:
            if now > last:
                credit = min(full, credit + (now - last) * gain)
                last = now
            taken = credit >= token
            if taken:
                credit -= token
            decisions.append(taken)
        self.last_us, self.credit = last, credit
        return decisions


class CreditMap:
    """Credit now as a function of the credit before the first event of a stretch.

    A credit is written as a place, and the credit now is place + ``shift``: a refill moves all
    credits by the shift, and so does a token, which those who cannot afford it get back by moving
    one token up in place. Two rules then describe all that happens to places. What would be more
    than the capacity falls to the highest place left, and what is below the lowest place that can
    pay is lifted by a token, onto the place of the credit that had one token more, with which it
    stays from there on. So at first the places in use are a single range that is cut at both of
    its ends, each event in constant time whatever the capacity.

    Once that range is no wider than a token nothing is lifted onto another place any more. The
    range is kept as pieces in order of their places, (lowest and highest place, lowest and highest
    start): the ones at the low end go round to the high end, and what falls to the capacity becomes
    a piece of one place. Only pieces at the two ends are touched.
    """

    def __init__(self, bucket: TokenBucket):
        self.gain, self.token, self.full = bucket.gain, bucket.token, bucket.full
        self.shift = 0
        self.low, self.high = 0, bucket.full
        self.pieces: deque[Piece] | None = None

    def event(self, elapsed_us: int) -> None:
        self.shift += elapsed_us * self.gain
        self._fall_to(self.full - self.shift)
        self.shift -= self.token
        self._lift_below(-self.shift)

    def _fall_to(self, top: int) -> None:
        """No place is higher than ``top``."""
        if self.pieces is None:
            self.high = min(self.high, top)
            self.low = min(self.low, self.high)
            return
        fallen = []
        while self.pieces and self.pieces[-1][1] > top:
            low, high, first, last = self.pieces.pop()
            if low <= top:
                self.pieces.append((low, top, first, first + top - low))
                first += top - low
            fallen.append((top, top, first, last))
        for piece in reversed(fallen):
            self._append(piece)

    def _lift_below(self, least: int) -> None:
        """Places lower than ``least`` move up by a token."""
        if self.pieces is None:
            if least <= self.low:
                return
            if least - 1 + self.token <= self.high:
                self.low = least
                return
            self.low = max(self.low, self.high - self.token + 1)
            self.pieces = deque([(self.low, self.high, self.low, self.high)])
        while self.pieces[0][0] < least:
            low, high, first, last = self.pieces.popleft()
            if high >= least:
                rest = least - low
                self.pieces.appendleft((least, high, first + rest, last))
                high, last = least - 1, first + rest - 1
            self._append((low + self.token, high + self.token, first, last))

    def _append(self, piece: Piece) -> None:
        """Puts a piece at the high end, as one with the last piece where it goes on with it."""
        low, high, first, last = piece
        if self.pieces:
            before = self.pieces[-1]
            goes_on = last >= first and before[3] + 1 == first
            flat, flat_before = low == high and first != last, before[0] == before[1] and before[2] != before[3]
            if goes_on and before[1] + 1 == low and not flat and not flat_before:
                self.pieces[-1] = (before[0], high, before[2], last)
                return
            if goes_on and before[0] == before[1] == low == high:
                self.pieces[-1] = (low, high, before[2], last)
                return
        self.pieces.append(piece)

    def constant(self) -> int | None:
        """The credit now, if it is the same from every start."""
        low, high = (self.low, self.high) if self.pieces is None else (self.pieces[0][0], self.pieces[-1][1])
        return low + self.shift if low == high else None

    def summary(self) -> dict:
        return {
            "token": self.token,
            "low": self.low,
            "high": self.high,
            "shift": self.shift,
            "pieces": None if self.pieces is None else list(self.pieces),
        }


def outcome(summary: dict, credit: int) -> int:
    """The credit after a stretch, from its :class:`CreditMap` and the credit before it."""
    token, place = summary["token"], credit
    if place < summary["low"]:
        place += -(-(summary["low"] - place) // token) * token
    place = min(place, summary["high"])
    if summary["pieces"] is not None:
        low, high, first, _ = next(p for p in summary["pieces"] if p[2] <= place <= p[3])
        place = min(high, low + place - first)
    return place + summary["shift"]


def settled(credit: int) -> dict:
    """The summary of a stretch whose outcome does not depend on its start."""
    return {"token": 1, "low": 0, "high": 0, "shift": credit, "pieces": None}


# Kinds of rows that the first fold gives: a decision, a row that stays open, the summary of a
# stretch (its first and last time and its credit map, as text, which holds integers of any size),
# and the last time and credit of a key that lies within one partition.
_DECIDED, _OPEN, _SUMMARY, _ENDED = 0, 1, 2, 3
_FOLDED = (
    "kind tinyint, key string, us bigint, now bigint, id {id_type}, admitted boolean, block int, "
    "first_us bigint, pieces string"
)


class _PartitionFold:
    """Fold over one sorted partition, key by key. A key's state, where there is one, precedes its rows."""

    def __init__(self, bucket: TokenBucket, block: int):
        self.bucket, self.block = bucket, block
        self.key = self.state = self.unknown = None
        self.first_key = self.first_us = None
        self.notes = []

    def _note(self, kind: int, pieces: str) -> None:
        self.notes.append(
            {
                "kind": kind,
                "key": self.key,
                "us": self.state.last_us,
                "now": self.state.last_us,
                "id": None,
                "admitted": False,
                "block": self.block,
                "first_us": self.first_us,
                "pieces": pieces,
            }
        )

    def _summarise(self) -> None:
        """Notes how the stretch of the current key ends."""
        found = settled(self.state.credit) if self.unknown is None else self.unknown.summary()
        self._note(_SUMMARY, json.dumps(found))

    def _begin(self, key, us: int, credit: str | None) -> None:
        if self.key is not None:
            if self.key == self.first_key:
                self._summarise()
            else:
                self._note(_ENDED, str(self.state.credit))
        self.first_us = us
        self.state = BucketState(us, self.bucket.full if credit is None else int(credit))
        is_first = self.first_key is None
        self.unknown = CreditMap(self.bucket) if is_first and credit is None else None
        self.first_key = key if is_first else self.first_key
        self.key = key

    def _open_rows(self, times: list[int]) -> int:
        """Feeds rows to the credit map until it is constant; returns how many stay open."""
        for seen, now in enumerate(times):
            self.unknown.event(now - self.state.last_us)
            self.state.last_us = now
            credit = self.unknown.constant()
            if credit is not None:
                self.state.credit, self.unknown = credit, None
                return seen + 1
        return len(times)

    def rows(self, batch: pd.DataFrame) -> pd.DataFrame:
        admitted, kinds = [], []
        for key, group in batch.groupby("key", sort=False):
            times, credit = group["now"].tolist(), group["credit"].iat[0]
            credit = None if pd.isna(credit) else credit
            if key != self.key:
                self._begin(key, times[0], credit)
            if credit is not None:  # the state that the key came with, no event
                times = times[1:]
                admitted.append(False)
                kinds.append(None)
            n_open = self._open_rows(times) if self.unknown is not None else 0
            admitted += [False] * n_open + self.state.admit(self.bucket, times[n_open:])
            kinds += [_OPEN] * n_open + [_DECIDED] * (len(times) - n_open)
        given = batch.assign(kind=kinds, admitted=admitted, block=self.block, first_us=0, pieces=None)
        return given[batch["credit"].isna()].astype({"kind": "int8"}).drop(columns="credit")

    def noted(self) -> pd.DataFrame:
        """What was noted since the last call."""
        notes, self.notes = self.notes, []
        return pd.DataFrame(notes)

    def ends(self) -> pd.DataFrame:
        self._summarise()
        return self.noted()


def _fold_partitions(bucket: TokenBucket):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition = _PartitionFold(bucket, TaskContext.get().partitionId())
        for batch in batches:
            if len(batch):
                yield partition.rows(batch)
                if partition.notes:
                    yield partition.noted()
        if partition.key is not None:
            yield partition.ends()

    return fold


def _chain(bucket: TokenBucket):
    """Credit at the start of each stretch of one key, from the stretches before it, and at the end
    of the last one, which has no block."""

    def chain(stretches: pd.DataFrame) -> pd.DataFrame:
        stretches = stretches.sort_values("block")
        state, credits = None, []
        for now, end, pieces in zip(stretches["first_us"], stretches["us"], stretches["pieces"]):
            credit = bucket.full
            if state is not None:
                credit = min(credit, state.credit + (int(now) - state.last_us) * bucket.gain)
            credits.append(str(credit))
            state = BucketState(int(end), outcome(json.loads(pieces), credit))
        key = stretches["key"].iat[0]
        starts = stretches.assign(credit=credits)[["key", "block", "first_us", "credit"]]
        last = {"key": [key], "block": [-1], "first_us": [state.last_us], "credit": [str(state.credit)]}
        return pd.concat([starts, pd.DataFrame(last)])

    return chain


def _fold_open(bucket: TokenBucket):
    """Decides the open rows, which come in order of their stretch and time."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = state = None
        for batch in batches:
            admitted = []
            for stretch, rows in batch.groupby(["block", "key"], sort=False):
                if stretch != at:
                    at = stretch
                    state = BucketState(int(rows["first_us"].iat[0]), int(rows["credit"].iat[0]))
                admitted += state.admit(bucket, rows["now"].tolist())
            if len(batch):
                yield batch.assign(admitted=admitted)[["key", "id", "admitted"]]

    return fold


def _key_text(key: str) -> Column:
    """The key as text that is never NULL; rows without a key share a bucket of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def token_bucket_admission(
    events: DataFrame,
    bucket: TokenBucket,
    key: str = "user_id",
    ts: str = "ts",
    event_id: str = "event_id",
    partitions: int | None = None,
) -> DataFrame:
    """(event_id, key, admitted) for every event, in order of (ts, event_id) within its key.

    The first fold is written to the shared folder: its partition boundaries come from a sample,
    and the steps that follow must see the same ones. It is laid out by the kind of row, so each
    step reads its own.
    """
    return admission_with_states(events, bucket, None, key, ts, event_id, partitions)[0]


def _not_before(given: DataFrame, states: DataFrame) -> DataFrame:
    """The events, with ``now`` no earlier than their key's state.

    Only those from before the latest state of all can be earlier and meet their key; all others,
    as a rule nearly all, are spread by their place.
    """
    latest = states.agg(F.max("last_us")).first()[0]
    if latest is None:
        return given
    known = states.select(F.col("key").alias("state_key"), "last_us")
    meets = F.when(F.col("us") < latest, F.col("key")).otherwise(F.concat(F.lit("#"), F.col("place")))
    joined = given.join(known, meets == F.col("state_key"), "left")
    return joined.withColumn("now", F.greatest("us", "last_us")).select(given.columns)


STATES = "key string, last_us bigint, credit string"


def admission_with_states(
    events: DataFrame,
    bucket: TokenBucket,
    states: DataFrame | None,
    key: str = "user_id",
    ts: str = "ts",
    event_id: str = "event_id",
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The decisions, and the states of all keys after them: their key, last time and credit.

    ``states`` are those that an earlier call gave; a key without one starts with a full bucket. A
    state takes part as a row before its key's events, so that a key with a third of all events
    spreads over tasks here as well. Events from before their key's state count as of its time.
    """
    id_type = events.schema[event_id].dataType.simpleString()
    order = ["key", "us", "id"]
    count = [partitions] if partitions else []
    given = events.select(
        _key_text(key).alias("key"),
        epoch_micros(F.col(ts)).alias("us"),
        epoch_micros(F.col(ts)).alias("now"),
        F.col(event_id).alias("id"),
        F.monotonically_increasing_id().alias("place"),
        F.lit(None).cast("string").alias("credit"),
    )
    if states is not None:
        held = states.select(
            "key",
            F.col("last_us").alias("us"),
            F.col("last_us").alias("now"),
            F.lit(None).cast(id_type).alias("id"),
            F.lit(-1).cast("bigint").alias("place"),
            "credit",
        )
        given = _not_before(given, states).unionByName(held)
        order = ["key", F.col("credit").isNull(), "us", "id"]
    ordered = (
        given.repartitionByRange(*count, *order, "place")
        .select("key", "us", "now", "id", "credit")
        .sortWithinPartitions(*order)
    )
    schema = _FOLDED.format(id_type=id_type)
    folded = written(ordered.mapInPandas(_fold_partitions(bucket), schema), "admission", "kind")

    kind = F.col("kind")
    starts = written(
        folded.where(kind == _SUMMARY)
        .select("key", "block", "first_us", "us", "pieces")
        .groupBy("key")
        .applyInPandas(_chain(bucket), "key string, block int, first_us bigint, credit string"),
        "admission-starts",
    )
    reopened = (
        folded.where(kind == _OPEN)
        .select("key", "block", "us", "now", "id")
        .join(F.broadcast(starts.where("block >= 0")), ["key", "block"])  # two rows a partition at most
        .repartition(*count, "block")
        .sortWithinPartitions("block", "key", "us", "id")
        .select("block", "key", "now", "id", "first_us", "credit")
        .mapInPandas(_fold_open(bucket), f"key string, id {id_type}, admitted boolean")
    )
    key_type = events.schema[key].dataType
    decisions = (
        folded.where(kind == _DECIDED)
        .select("key", "id", "admitted")
        .unionByName(reopened)
        .select(
            F.col("id").alias(event_id),
            F.when(F.col("key") != "", F.substring("key", 2, 2**31 - 1)).cast(key_type).alias(key),
            "admitted",
        )
    )
    ended = folded.where(kind == _ENDED).select("key", F.col("us").alias("last_us"), F.col("pieces").alias("credit"))
    last = starts.where("block < 0").select("key", F.col("first_us").alias("last_us"), "credit")
    return decisions, ended.unionByName(last)
