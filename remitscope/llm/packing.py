"""Packing of tokenised documents into sequences of one capacity, by harmonic classes."""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from remitscope.llm.common import keyed_texts, text_batches

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 1
LEAST_CUT = 64
LONG_RUN = 400

# Characters whose class all versions of Unicode agree on; other texts take the slower encoder.
COMMON = re.compile("[\x09\x0a\x0d\x20-\x7e\xa1-ɏ‐-‧]*")


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones for themselves,
    the rest in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary, as ``tokenizers`` gives them for the whole text.

    Texts of common characters and without very long runs go through ``tiktoken`` with the ranks
    of the same vocabulary, which gives the same ids several times faster; the others go through
    ``tokenizers`` itself. Strings of special tokens are ordinary text.
    """

    def __init__(self, content: bytes):
        self.slow = Tokenizer.from_str(content.decode())
        self.slow.encode_special_tokens = True
        symbols = byte_symbols()
        special = {t["content"] for t in json.loads(content)["added_tokens"]}
        ranks = {
            bytes(symbols[c] for c in token): i
            for token, i in self.slow.get_vocab().items()
            if token not in special
        }
        pattern = public_tokenizers.PATTERN
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if COMMON.fullmatch(text) and longest_run(text.encode()) < LONG_RUN:
            return self.fast.encode_to_numpy(text).astype("<u4")
        ids = self.slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4")


def longest_run(data: bytes) -> int:
    """The longest stretch of blank bytes, or of others."""
    blank = np.frombuffer(data, dtype=np.uint8) <= 32
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    return int(np.diff(np.r_[-1, turns, len(blank) - 1]).max(initial=0)) if len(blank) else 0


def cuts(length: int, capacity: int, least: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then halves, quarters, ..., then the rest."""
    pieces = [capacity] * (length // capacity)
    length %= capacity
    size = capacity // 2
    while size >= least:
        if length >= size:
            pieces.append(size)
            length -= size
        size //= 2
    return pieces + ([length] if length else [])


class Packer:
    """The bins of one worker.

    A piece of length n is of class k = capacity // n, and a bin of class k is full with k pieces;
    only then its rows are given out. What is left in open bins at the end runs through full
    sequences, cut where they end, and the last tokens through sequences whose lengths are powers
    of two, so open bins leave no padding. At most capacity * ln(least) small pieces and one bin
    of each larger class are waiting.
    """

    def __init__(self, first_sequence: int, capacity: int, least: int):
        self.capacity, self.least = capacity, least
        self.numbers = count(first_sequence)
        self.open: dict[int, list] = defaultdict(list)
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        for length in cuts(len(ids), self.capacity, self.least):
            k = self.capacity // length
            waiting = self.open[k]
            waiting.append((doc_id, start, ids[start : start + length], len(ids)))
            if len(waiting) == k:
                self.sequence(waiting)
                self.open[k] = []
            start += length

    def sequence(self, pieces: list) -> None:
        number, offset = next(self.numbers), 0
        for doc_id, start, ids, total in pieces:
            check = zlib.crc32(ids.tobytes())
            self.rows.append((doc_id, start, len(ids), check, total, number, offset))
            offset += len(ids)

    def close(self) -> None:
        pieces = [piece for k in sorted(self.open) for piece in self.open[k]]
        left = sum(len(piece[2]) for piece in pieces)
        room = self.capacity
        current: list = []
        for doc_id, start, ids, total in pieces:
            while len(ids):
                while room > left:
                    room //= 2
                taken = ids[: room - sum(len(piece[2]) for piece in current)]
                current.append((doc_id, start, taken, total))
                start, ids = start + len(taken), ids[len(taken) :]
                if sum(len(piece[2]) for piece in current) == room:
                    self.sequence(current)
                    left -= room
                    current = []
        self.open.clear()

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(ROW)
        self.rows = []
        arrays = [pa.array(column, pa.int64()) for column in columns]
        return pa.RecordBatch.from_arrays(arrays, names=ROW)


ROW = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def worker(content: bytes, capacity: int, least: int, end_id: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(content)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, least)
        end = np.array([end_id], dtype="<u4")
        for ids, texts in text_batches(batches):
            for doc_id, text in zip(ids, texts):
                packer.add(doc_id, np.concatenate([encode(text), end]))
            yield packer.taken()
        packer.close()
        yield packer.taken()

    return pack


def packed(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    least: int = LEAST_CUT,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence of ``capacity`` tokens.

    Each worker packs the rows it reads by itself, without a shuffle. A document's remainder is
    cut into powers of two down to ``least``, so bins of these classes are filled to the last
    token; its last few tokens go to the harmonic class of their length, whose full bins pad less
    than 1 / (k + 1) of a sequence.

    A null or empty text is one piece of the end id. Repeated rows are packed each. A null id stays
    null. Texts of any length are held once per task. Other columns are ignored. An empty table
    gives no rows. Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.
    """
    content = Path(vocabulary or public_tokenizers.path(VOCABULARY)).read_bytes()
    schema = ", ".join(f"{name} long" for name in ROW)
    return keyed_texts(docs).mapInArrow(worker(content, capacity, least, end_id), schema)
