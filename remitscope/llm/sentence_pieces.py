"""SentencePiece ids and back, segmenting each distinct marked word once."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from remitscope.llm.common import keyed_texts, text_batches

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
UNIT_CHARS = 16_000_000
SHARD_ROWS = 8_000
MOST_WORDS = 2_000_000

CHUNK = re.compile(f"{MARKER}*[^{MARKER}\n]+|{MARKER}+|\n")


def processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_cuts(model: bytes) -> None:
    """Raises unless no piece reaches over a cut: before a marker, and around a line feed."""
    pieces = processor(model)
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        if MARKER in piece.lstrip(MARKER) or "\n" in piece:
            raise ValueError(f"piece {i} reaches over a cut between marked words: {piece!r}")


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def spread(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, first all their lowest bytes, then the next."""
    return squeeze(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def from_planes(data: bytes) -> np.ndarray:
    return spread(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


ROW = {
    "key": pa.int64(),
    "unit": pa.int64(),
    "shard": pa.int32(),
    "sizes": pa.binary(),
    "body": pa.binary(),
    "more": pa.binary(),
}
ROW_SCHEMA = "key long, unit long, shard int, sizes binary, body binary, more binary"
DOCUMENTS = -1


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(ROW)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, ROW.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(ROW))


class Unit:
    """Documents that one task read one after the other, as places in a list of distinct words."""

    def __init__(self, number: int):
        self.number = number
        self.words: dict[str, int] = {}
        self.doc_ids: list[int | None] = []
        self.places: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str) -> None:
        chunks = CHUNK.findall(MARKER + text.replace(" ", MARKER)) if text else []
        known = self.words
        places = [known.setdefault(chunk, len(known)) for chunk in chunks]
        self.doc_ids.append(doc_id)
        self.places.append(np.array(places, dtype=np.uint32))
        self.chars += len(text)

    def rows(self, shards: int) -> list[tuple]:
        """One row with the documents, under the unit's key, and one for each shard of its words.

        Words are numbered by falling frequency, which makes the places compress better.
        """
        places = np.concatenate(self.places)
        order = np.argsort(-np.bincount(places, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        listed = list(self.words)
        encoded = [listed[i].encode() for i in order.tolist()]
        shard_of = np.array([zlib.crc32(word) % shards for word in encoded], dtype="<u4")
        missing = np.array([d is None for d in self.doc_ids])
        ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        head = ids.tobytes() + missing.tobytes()
        sizes = np.array([len(p) for p in self.places], dtype="<u4")
        rows = [
            (
                self.number,
                self.number,
                DOCUMENTS,
                squeeze(sizes.tobytes() + head),
                planes(rank[places]),
                planes(shard_of),
            )
        ]
        for shard in np.unique(shard_of).tolist():
            own = [encoded[i] for i in np.flatnonzero(shard_of == shard).tolist()]
            lengths = np.array([len(word) for word in own])
            rows.append((shard, self.number, shard, planes(lengths), squeeze(b"".join(own)), b""))
        return rows


def splitter(shards: int, unit_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        unit = Unit(number)
        for ids, texts in text_batches(batches):
            for doc_id, text in zip(ids, texts):
                unit.add(doc_id, text)
                if unit.chars >= unit_chars:
                    yield batch_of(unit.rows(shards))
                    number += 1
                    unit = Unit(number)
        if unit.doc_ids:
            yield batch_of(unit.rows(shards))

    return split


def segmenter(model: bytes, most_words: int):
    """Rows of words become rows of ids under the unit's key; each distinct word is segmented once.

    The line feed before a word keeps the marker that the library puts before a text away from it;
    both are cut off again. The words of a shard are forgotten when they are very many.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = processor(model)
        before = len(pieces.encode("\n"))
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(ROW)}
                if row["shard"] == DOCUMENTS:
                    continue
                lengths = from_planes(row["sizes"]).astype(np.int64)
                data = spread(row["body"], np.uint8).tobytes()
                ends = np.cumsum(lengths).tolist()
                words = [data[a:b] for a, b in zip([0, *ends], ends)]
                if len(known) > most_words:
                    known.clear()
                new = [word for word in words if word not in known]
                coded = pieces.encode(["\n" + word.decode() for word in new], num_threads=1)
                known.update(zip(new, (ids[before:] for ids in coded)))
                found = [known[word] for word in words]
                counts = np.array([len(ids) for ids in found])
                flat = np.array([x for ids in found for x in ids])
                out = (row["unit"], row["unit"], row["shard"], planes(counts), planes(flat), b"")
                yield batch_of([out])

    return segment


RESULT = {
    "doc_id": pa.int64(),
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}


def hexdigest(data: bytes) -> str:
    return sha256(data).hexdigest()


class Ids:
    """The ids of a unit's words, from the rows that its shards sent back."""

    def __init__(self, shard_of: np.ndarray, rows: list[dict]):
        self.counts = np.zeros(len(shard_of), dtype=np.int64)
        self.starts = np.zeros(len(shard_of), dtype=np.int64)
        flats, at = [], 0
        for row in rows:
            own = np.flatnonzero(shard_of == row["shard"])
            counts = from_planes(row["sizes"]).astype(np.int64)
            self.counts[own] = counts
            self.starts[own] = at + np.cumsum(counts) - counts
            flats.append(from_planes(row["body"]).astype(np.int64))
            at += len(flats[-1])
        self.flat = np.concatenate([np.zeros(0, dtype=np.int64), *flats])

    def of(self, places: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after the other."""
        counts = self.counts[places]
        skipped = np.cumsum(counts) - counts
        return self.flat[np.repeat(self.starts[places] - skipped, counts) + np.arange(counts.sum())]


def joiner(model: bytes):
    def join(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = processor(model)
        out: dict[str, list] = {name: [] for name in RESULT}
        for row in left.to_pylist():
            if row["shard"] != DOCUMENTS:
                continue
            words = Ids(from_planes(row["more"]), right.to_pylist())
            head = spread(row["sizes"], np.uint8)
            n = len(head) // 13
            sizes = head[: 4 * n].copy().view("<u4").astype(np.int64)
            doc_ids = head[4 * n : 12 * n].copy().view("<i8")
            missing = head[12 * n :].astype(bool)
            places = from_planes(row["body"])
            at = 0
            for doc_id, null, size in zip(doc_ids.tolist(), missing.tolist(), sizes.tolist()):
                ids = words.of(places[at : at + size]).tolist()
                at += size
                out["doc_id"].append(None if null else doc_id)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hexdigest(",".join(map(str, ids)).encode()))
                out["decoded_sha256"].append(hexdigest(pieces.decode(ids).encode()))
        return pa.table([pa.array(out[n], kind) for n, kind in RESULT.items()], names=list(RESULT))

    return join


def piece_digests(
    docs: DataFrame,
    model_file: str | None = None,
    unit_chars: int = UNIT_CHARS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """n_tokens and the digests of the ids and of the decoded text, for every document.

    No piece of the model reaches over the start of a run of markers or a line feed (this is
    checked), so a text's ids are those of its marked words. A task turns the texts that it reads,
    16 million characters at a time, into a unit: the places of its words in a list of its distinct
    words. The lists are dealt to shards by the hash of the word; a shard segments each distinct
    word once and sends the ids back to the units, where the ids are joined by position and
    decoded. One exchange carries both lists and places; no word is sent more often than once per
    unit, however frequent.

    Null and empty texts have no ids: n_tokens 0 and the digest of nothing. Repeated rows give
    equal rows; a null id stays null. A longer text is a unit by itself. Other columns are ignored.
    An empty table gives no rows. A shard with over two million words forgets them and goes on.
    """
    model = Path(model_file or public_tokenizers.path(MODEL)).read_bytes()
    check_cuts(model)
    spark = docs.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-docs.count() // shard_rows))
    dealt = (
        keyed_texts(docs)
        .mapInArrow(splitter(shards, unit_chars), ROW_SCHEMA)
        .repartition("key")
    )
    ids = dealt.mapInArrow(segmenter(model, MOST_WORDS), ROW_SCHEMA)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return dealt.groupBy("key").cogroup(ids.groupBy("key")).applyInArrow(joiner(model), schema)
