"""Passages that repeat across documents: automata of confirmed phrases find and remove them."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from remitscope.llm.words import BLANK, Words, grams, sliding, word_hashes, words_of

WINDOW = 20
PHRASE = 8
UNIT_BYTES = 4_000_000
SHARD_BYTES = 32_000_000
MOST_PHRASES = 50_000
DIGITS = 64
LAST = np.iinfo(np.int64).max

ANCHORS, FIRSTS = 0, 1
ROW = {"key": pa.int64(), "unit": pa.int64(), "shard": pa.int64(), "kind": pa.int32(), "body": pa.binary()}
SCHEMA = "key long, unit long, shard long, kind int, body binary"


def table_of(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(ROW)
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, ROW.values())], names=list(ROW))


def cut_at(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's part of the sorted hashes begins; shards are equal ranges of hashes."""
    shard = (sorted_hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


def squeeze(numbers: np.ndarray) -> bytes:
    """64-bit numbers, first all their lowest bytes, then the next."""
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def spread(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(8, -1).T.copy().view("<i8").reshape(-1)


class Unit:
    """Documents of one bucket in the order of their ids, with the hashes of their windows.

    A window's anchor is the smallest hash of a phrase of eight words in it; equal windows have
    equal anchors. ``values`` are the distinct anchors, ``at`` a place of each.
    """

    def __init__(self, docs: pa.Table, window: int):
        self.docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.window, reach = window, window - PHRASE + 1
        self.words: Words = words_of(self.docs.column("text"))
        counts = self.words.lasts - self.words.firsts
        n = len(self.words.starts)
        self.hashes = word_hashes(self.words)
        self.doc_of = np.repeat(np.arange(len(counts)), counts)
        size = max(0, n - window + 1)
        self.valid = (np.repeat(self.words.lasts, counts) - np.arange(n) >= window)[:size]
        self.high = grams(self.hashes, window)
        self.low = grams(word_hashes(self.words, 7), window)
        phrases = grams(self.hashes, PHRASE)
        self.anchor = sliding(phrases, reach, np.minimum) if size else np.zeros(0, np.uint64)
        around = np.zeros(size + 2 * (reach - 1), dtype=np.uint64)
        around[reach - 1 : reach - 1 + size] = np.where(self.valid, self.anchor, 0)
        least = sliding(around, reach, np.maximum) if size else np.zeros(0, np.uint64)
        places = np.flatnonzero((least == phrases[: len(least)]) & (least > 0))
        self.values, first, self.counts = np.unique(
            phrases[places], return_index=True, return_counts=True
        )
        self.at = places[first]

    def ids(self) -> np.ndarray:
        ids = self.docs.column("doc_id").fill_null(LAST)
        return ids.to_numpy().astype(np.int64)

    def candidates(self, replies: dict) -> tuple[np.ndarray, ...]:
        """Distinct windows with an anchor that recurs: hashes, first place, number of places."""
        recurs = (self.counts > 1) | replies_bits(replies, ANCHORS, len(self.values))
        places = np.flatnonzero(self.valid)
        places = places[recurs[np.searchsorted(self.values, self.anchor[places])]]
        order = np.lexsort((self.low[places], self.high[places]))
        places = places[order]
        high, low = self.high[places], self.low[places]
        new = np.ones(len(places), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        heads = np.flatnonzero(new)
        return high[heads], low[heads], places[heads], np.diff(np.r_[heads, len(places)])


def replies_bits(replies: dict, kind: int, n: int) -> np.ndarray:
    """The bits of all shards one after the other; each shard answered for a range of hashes."""
    parts = [replies[key] for key in sorted(k for k in replies if k[0] == kind)]
    bits = np.concatenate(parts) if parts else np.zeros(0, dtype=bool)
    if len(bits) != n:
        raise ValueError(f"{len(bits)} answers to {n} questions")
    return bits


def replies_of(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Bits by kind and shard."""
    found = {}
    for row in table.to_pylist():
        size = int.from_bytes(row["body"][:8], "little")
        bits = np.unpackbits(np.frombuffer(row["body"], np.uint8, offset=8), count=size)
        found[row["kind"], row["shard"]] = bits.astype(bool)
    return found


def reply(unit: int, shard: int, kind: int, bits: np.ndarray) -> tuple:
    body = len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes()
    return unit, unit, shard, kind, body


def ask_anchors(shards: int, window: int):
    """The distinct anchors of a unit, dealt to the shards of their hashes."""

    def ask(key: tuple, docs: pa.Table) -> pa.Table:
        unit = Unit(docs, window)
        cuts = cut_at(unit.values, shards).tolist()
        number = key[0].as_py()
        return table_of(
            [
                (shard, number, shard, ANCHORS, unit.values[a:b].tobytes())
                for shard, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
        )

    return ask


def answer_anchors(key: tuple, asked: pa.Table) -> pa.Table:
    """Which anchors of each unit other units have too."""
    rows = asked.to_pylist()
    parts = [np.frombuffer(row["body"], np.uint64) for row in rows]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    recurs = np.zeros(len(values), dtype=bool)
    recurs[order[1:]] |= same
    recurs[order[:-1]] |= same
    ends = np.cumsum([len(part) for part in parts])
    return table_of(
        [
            reply(row["unit"], row["shard"], ANCHORS, bits)
            for row, bits in zip(rows, np.split(recurs, ends[:-1]))
        ]
    )


def windows_body(high: np.ndarray, low: np.ndarray, ids: np.ndarray) -> bytes:
    return len(ids).to_bytes(8, "little") + high.tobytes() + low.tobytes() + squeeze(ids)


def windows_from(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    high, low = (np.frombuffer(body, np.uint64, n, 8 + 8 * n * i) for i in range(2))
    return high, low, spread(body[8 + 16 * n :])


def ask_windows(shards: int, window: int):
    """The distinct candidate windows of a unit, each with the id of its first document there."""

    def ask(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(docs):
            return table_of([])
        unit = Unit(docs, window)
        high, low, first, _ = unit.candidates(replies_of(replies))
        ids = unit.ids()[unit.doc_of[first]]
        cuts = cut_at(high, shards)
        number = key[0].as_py()
        return table_of(
            [
                (shard, number, shard, FIRSTS, windows_body(high[a:b], low[a:b], ids[a:b]))
                for shard, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()))
                if b > a
            ]
        )

    return ask


def answer_windows(key: tuple, asked: pa.Table) -> pa.Table:
    """Which windows of each unit stand earlier in another unit."""
    rows = sorted(asked.to_pylist(), key=lambda row: row["unit"])
    parts = [windows_from(row["body"]) for row in rows]
    high, low, ids = (np.concatenate(columns) for columns in zip(*parts))
    sizes = [len(part[0]) for part in parts]
    order = np.lexsort((ids, low, high))  # stable: of equal ids the smaller unit comes first
    high, low = high[order], low[order]
    elsewhere = np.zeros(len(order), dtype=bool)
    elsewhere[order[1:]] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    return table_of(
        [
            reply(row["unit"], row["shard"], FIRSTS, bits)
            for row, bits in zip(rows, np.split(elsewhere, np.cumsum(sizes)[:-1]))
        ]
    )


def word_numbers(words: Words) -> np.ndarray:
    """A number for each distinct word, by its bytes."""
    content = words.data[~BLANK[words.data] & (np.arange(len(words.data)) < words.offsets[-1])]
    offsets = np.r_[0, np.cumsum(words.ends - words.starts)].astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(content)]
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
    return listed.dictionary_encode().indices.to_numpy()


def as_symbols(numbers: np.ndarray) -> tuple[str, int]:
    """Numbers as text, each of the same few symbols, and how many.

    A number is written in digits, each place of which has symbols of its own, so that no digit is
    taken for one of another place. Few symbols keep the automata's nodes small.
    """
    width = 1
    while DIGITS**width <= int(numbers.max(initial=0)):
        width += 1
    places = np.arange(width)
    digits = numbers[:, None] // DIGITS**places % DIGITS + DIGITS * places + 1
    return digits.astype("<u2").tobytes().decode("utf-16-le"), width


def phrase_places(unit: Unit, numbers: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases that stand at ``places``: the number of each, and that of the phrase which starts
    at each word of the unit, or -1.

    The distinct phrases are compiled into automata of at most MOST_PHRASES each, and all documents
    of the unit are streamed through every automaton.
    """
    found = np.full(len(numbers), -1, dtype=np.int64)
    text, width = as_symbols(numbers)
    size = PHRASE * width
    known: dict[str, int] = {}
    own = np.array(
        [known.setdefault(text[at : at + size], len(known)) for at in (places * width).tolist()], dtype=np.int64
    )
    spans = [
        (first, text[first * width : last * width])
        for first, last in zip(unit.words.firsts.tolist(), unit.words.lasts.tolist())
        if last - first >= unit.window
    ]
    phrases = list(known)
    for at in range(0, len(phrases), MOST_PHRASES):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, phrase in enumerate(phrases[at : at + MOST_PHRASES], at):
            automaton.add_word(phrase, i)
        automaton.make_automaton()
        for first, words in spans:
            hits = list(automaton.iter(words))
            if hits:
                ends, which = np.array(hits, dtype=np.int64).T
                found[(ends + 1) // width + first - PHRASE] = which
    return own, found


def located(unit: Unit, windows: np.ndarray) -> np.ndarray:
    """Which of the windows that stand at some places starts at each word of the unit, or -1.

    A window is its phrases at a few places that together cover it, so it occurs wherever the
    automata find these phrases in these places, word for word.
    """
    steps = [*range(0, unit.window - PHRASE, PHRASE), unit.window - PHRASE]
    own, found = phrase_places(unit, word_numbers(unit.words), np.concatenate([windows + s for s in steps]))
    size = len(unit.valid)
    wanted, there = own[: len(windows)], found[:size]
    for i, step in enumerate(steps[1:], 1):
        second = own[i * len(windows) : (i + 1) * len(windows)]
        many = int(second.max()) + 1
        pairs, wanted = np.unique(wanted * many + second, return_inverse=True)
        after = found[step : step + size]
        code = there * many + after
        match = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
        fits = (there >= 0) & (after >= 0) & (after < many) & (pairs[match] == code)
        there = np.where(fits, match, -1)
    place = np.empty(len(windows), dtype=np.int64)
    place[wanted] = np.arange(len(windows))
    return np.where(unit.valid & (there >= 0), place[there], -1)


def repeats(unit: Unit, replies: dict) -> np.ndarray:
    """The words that a window covers whose words also start earlier."""
    high, _, first, counts = unit.candidates(replies)
    elsewhere = replies_bits(replies, FIRSTS, len(high))
    confirmed = elsewhere | (counts > 1)
    first, elsewhere = first[confirmed], elsewhere[confirmed]
    covered = np.zeros(len(unit.hashes), dtype=bool)
    if not len(first):
        return covered
    window = located(unit, first)
    places = np.flatnonzero(window >= 0)
    places = places[elsewhere[window[places]] | (places != first[window[places]])]
    edges = np.zeros(len(covered) + 1, dtype=np.int32)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + unit.window, -1)
    return np.cumsum(edges)[:-1] > 0


def kept_texts(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    edges = np.zeros(len(words.data) + 1, dtype=np.int32)
    edges[words.starts[kept]] += 1
    edges[words.ends[kept] + 1] -= 1  # the byte after a word is a blank of some kind
    inside = np.cumsum(edges)[:-1] > 0
    data = words.data.copy()
    data[words.ends] = ord(" ")
    out = data[inside].tobytes()
    sizes = np.r_[0, np.cumsum(inside)]
    places = sizes[words.offsets].tolist()
    return pa.array([out[a : max(a, b - 1)].decode() for a, b in zip(places, places[1:])], pa.string())


def remove_repeats(window: int):
    def remove(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        unit = Unit(docs, window)
        covered = repeats(unit, replies_of(replies)) if len(docs) else np.zeros(0, dtype=bool)
        removed = np.r_[0, np.cumsum(covered)]
        words = unit.words
        columns = {
            "doc_id": unit.docs.column("doc_id"),
            "n_words": pa.array(words.lasts - words.firsts, pa.int64()),
            "n_removed": pa.array(removed[words.lasts] - removed[words.firsts], pa.int64()),
            "text": kept_texts(words, ~covered),
            "rest": unit.docs.column("rest"),
        }
        return pa.table(columns)

    return remove


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_repeats(
    docs: DataFrame, window: int = WINDOW, unit_bytes: int = UNIT_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Every document without the words that repeat an earlier passage.

    A window is ``window`` consecutive words of a document; a word is removed if a window covers
    it whose words also start earlier: in a document with a smaller id, or before in the same one.
    Windows are judged on the input. Returns doc_id, n_words, n_removed, text (the kept words,
    joined by one blank) and rest, a struct of all other columns.

    Documents are dealt to units of about 4 MB by a hash; one exchange of the texts serves three
    passes. A window's anchor is its eight-word phrase of the smallest hash. First the units ask
    shards, which own ranges of hashes, which of their distinct anchors other units have; then, of
    the windows around those alone, which stand earlier elsewhere (compared by 128 bits). What is
    confirmed is compiled into automata of phrases of words, a few for each window, and all documents
    of the unit are streamed through them: a window occurs where the automata find its phrases, and
    only such places are removed. A unit names each anchor and window once, so a passage that is in a third of
    all documents weighs no more in a shard than one row of a unit.

    A null text has no words and gives an empty text. A null id counts as the largest. Rows that
    share an id have a fixed order, by unit and text. An empty table gives no rows.
    """
    if window < PHRASE:
        raise ValueError(f"a window has at least {PHRASE} words")
    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in ("doc_id", "text")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        (F.struct(*others) if others else F.lit(None).cast("int")).alias("rest"),
    )
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    units = max(partitions(spark), -(-size // unit_bytes))
    shards = max(partitions(spark), -(-size // shard_bytes))
    dealt = rows.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(units))).groupBy("unit")
    anchors = (
        dealt.applyInArrow(ask_anchors(shards, window), SCHEMA)
        .groupBy("key")
        .applyInArrow(answer_anchors, SCHEMA)
    )
    windows = (
        dealt.cogroup(anchors.groupBy("key"))
        .applyInArrow(ask_windows(shards, window), SCHEMA)
        .groupBy("key")
        .applyInArrow(answer_windows, SCHEMA)
    )
    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, text string")
    return dealt.cogroup(anchors.unionByName(windows).groupBy("key")).applyInArrow(
        remove_repeats(window), schema.add("rest", rows.schema["rest"].dataType)
    )
