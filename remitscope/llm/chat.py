"""Conversations as training text, assembled column by column, with the spans that count in the loss."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000
HOT_KEYS = 4096
CHUNK_BYTES = 4_000_000
PIECE_BYTES = 16_000_000

# Strings that chat templates give a meaning.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<SYS>>", "</SYS>>",
)


@dataclass(frozen=True)
class Template:
    """A turn is ``start``, the role, ``middle``, the text and ``end``; the text of ``learnt`` roles
    counts in the loss.

    Inside a text a control string gets a backslash after its first character, and one that has
    backslashes there already gets one more; so a text never holds a control string, and taking
    one backslash away gives the text back. No control string may hold a first character of any
    other than at its own beginning, so that no two overlap. In a role, backslashes and line feeds
    are written as two characters.
    """

    start: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>\n"
    control: tuple[str, ...] = CONTROL
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        openers = {c[0] for c in self.control}
        for c in self.control:
            if set(c[1:]) & openers or c[1:2] in ("", "\\"):
                raise ValueError(f"control string {c!r} cannot be escaped")
        if self.start not in self.control or self.end.rstrip("\n") not in self.control or self.middle != "\n":
            raise ValueError("turns must be marked by control strings, and a role end with a line feed")

    def pattern(self, least: str) -> str:
        """First characters, backslashes (``*`` or ``+``) and rests, in two groups for each opener."""
        by_opener: dict[str, list[str]] = {}
        for c in self.control:
            by_opener.setdefault(c[0], []).append(c[1:])
        return "|".join(
            f"({re.escape(opener)}\\\\{least})({'|'.join(re.escape(r) for r in rests)})"
            for opener, rests in by_opener.items()
        )

    def escaped(self, texts: pa.Array) -> pa.Array:
        groups = re.compile(self.pattern("*")).groups
        opener = "".join(f"\\{i}" for i in range(1, groups + 1, 2))
        rest = "".join(f"\\{i}" for i in range(2, groups + 1, 2))
        return pc.replace_substring_regex(texts, self.pattern("*"), f"{opener}\\\\{rest}")

    def unescaped(self, text: str) -> str:
        def less(match: re.Match) -> str:
            opener, rest = (g for g in match.groups() if g is not None)
            return opener[:-1] + rest

        return re.sub(self.pattern("+"), less, text)

    def role_escaped(self, roles: pa.Array) -> pa.Array:
        roles = pc.replace_substring(roles, "\\", "\\\\")
        return self.escaped(pc.replace_substring(roles, "\n", "\\n"))

    def role_unescaped(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), self.unescaped(role))

    def turns(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(role, start, end) of each turn's text, still escaped, in a formatted text."""
        at = 0
        while at < len(text):
            if not text.startswith(self.start, at):
                raise ValueError(f"no turn begins at {at}")
            head = text.index(self.middle, at)
            end = text.index(self.end, head)
            yield self.role_unescaped(text[at + len(self.start) : head]), head + len(self.middle), end
            at = end + len(self.end)


def content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and the places where each begins, and the last ends."""
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    found = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    return found, offsets - offsets[0]


def assemble(parts: list[bytes | tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' parts one after the other in one buffer, and where each part begins.

    A part is the same bytes for each of ``n`` rows, or a column of texts. Returns the buffer and an
    array of ``n`` rows and a column for each part, with one more row for the end.
    """
    lengths = np.empty((n, len(parts)), np.int64)
    for j, part in enumerate(parts):
        lengths[:, j] = len(part) if isinstance(part, bytes) else np.diff(part[1])
    ends = np.cumsum(lengths.reshape(-1))
    starts = np.zeros(n * len(parts) + 1, np.int64)
    starts[1:] = ends
    out = np.empty(int(starts[-1]), np.uint8)
    for j, part in enumerate(parts):
        at = starts[j : -1 : len(parts)]
        if isinstance(part, bytes):
            out[at[:, None] + np.arange(len(part))] = np.frombuffer(part, np.uint8)
        else:
            data, offsets = part
            out[np.arange(len(data)) + np.repeat(at - offsets[:-1], np.diff(offsets))] = data
    return out, starts


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int32()),
        ("piece", pa.int32()),
        ("whole", pa.bool_()),
        ("n_turns", pa.int64()),
        ("text", pa.string()),
        ("loss_spans", SPANS),
    ]
)
FORMATTED_SQL = (
    "conv_id long, block int, piece int, whole boolean, n_turns long, text string, "
    "loss_spans array<struct<start: long, end: long>>"
)


def runs(rows: pa.Table) -> np.ndarray:
    """Where each conversation's rows begin."""
    ids = rows.column("conv_id").combine_chunks()
    known, missing = pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.r_[True, (known[1:] != known[:-1]) | (missing[1:] != missing[:-1])])


def formatted(rows: pa.Table, template: Template) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Text, loss spans (in code points) and number of turns of each run of rows of a conversation."""
    n, first = rows.num_rows, runs(rows)
    texts, roles = (rows.column(c).combine_chunks() for c in ("text", "role"))
    escaped, names = template.escaped(texts), template.role_escaped(roles)
    marks = [m.encode() for m in (template.start, template.middle, template.end)]
    parts = [marks[0], content(names), marks[1], content(escaped), marks[2]]
    out, starts = assemble(parts, n)
    bounds = np.r_[starts[:-1:5][first], starts[-1]]
    # Places in code points: the bytes that begin one, counted up to there.
    begun = np.zeros(len(out) + 1, np.int64)
    np.cumsum((out & 0xC0) != 0x80, out=begun[1:])
    learnt = np.flatnonzero(pc.is_in(roles, pa.array(template.learnt, pa.string())).to_numpy(zero_copy_only=False))
    run = np.searchsorted(first, learnt, "right") - 1
    base = begun[bounds[run]]
    spans = pa.StructArray.from_arrays(
        [pa.array(begun[starts[5 * learnt + k]] - base) for k in (3, 4)], names=["start", "end"]
    )
    per_run = np.r_[0, np.cumsum(np.bincount(run, minlength=len(first)))].astype(np.int32)
    text = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out))
    return text, pa.ListArray.from_arrays(pa.array(per_run), spans), np.diff(np.r_[first, n])


def formatter(template: Template):
    """Streams sorted rows: conversations leave whole, or in pieces where one is very large."""

    def batch_of(rows: pa.Table, block: int, pieces: list[int], whole: list[bool]) -> pa.RecordBatch:
        text, spans, turns = formatted(rows, template)
        ids = rows.column("conv_id").combine_chunks().take(pa.array(np.r_[0, np.cumsum(turns)[:-1]]))
        columns = [ids, [block] * len(text), pieces, whole, turns, text, spans]
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, FORMATTED)],
            schema=FORMATTED,
        )

    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, piece, open_id, held = TaskContext.get().partitionId(), 0, None, None

        def given(rows: pa.Table, ends: bool) -> pa.RecordBatch:
            """The rows' conversations; the first may go on with an open one, the last may stay open."""
            nonlocal piece, open_id
            starts = runs(rows)
            hot = rows.column("hot").combine_chunks().take(pa.array(starts)).to_pylist()
            ids = rows.column("conv_id").combine_chunks().take(pa.array(starts)).to_pylist()
            goes_on = piece > 0 and ids[0] == open_id
            pieces = [0] * len(starts)
            pieces[0] = piece if goes_on else 0
            whole = [not h for h in hot]
            whole[0] &= not goes_on
            whole[-1] &= ends
            piece, open_id = (0, None) if ends else (pieces[-1] + 1, ids[-1])
            return batch_of(rows, block, pieces, whole)

        def parts(rows: pa.Table) -> Iterator[pa.Table]:
            """Rows of at most about CHUNK_BYTES, cut between conversations where that can be."""
            sizes = pc.add(pc.fill_null(pc.binary_length(rows.column("text")), 0), 64).to_numpy()
            number = (np.cumsum(sizes) - sizes) // CHUNK_BYTES
            cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                yield rows.slice(a, b - a)

        for batch in batches:
            for part in parts(pa.Table.from_batches([batch])) if batch.num_rows else ():
                held = part if held is None else pa.concat_tables([held, part])
                last = int(runs(held)[-1])
                if last:
                    yield given(held.slice(0, last), True)
                    held = held.slice(last)
                if held.nbytes > PIECE_BYTES:
                    yield given(held, False)
                    held = None
        if held is not None:
            yield given(held, True)

    return format_


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, block, piece, whole, n_turns, text and loss_spans of each conversation.

    ``turns`` has conv_id, turn, role and text. Rows go by turn (without one first), equal turns by
    role and text; each is written as the template says. Arrow batches are assembled as columns:
    lengths of all segments, their cumulative offsets, and one scatter of headers and texts into the
    buffer of the text column. ``loss_spans`` are the places, in code points of ``text``, of what
    roles of ``learnt`` say.

    A conversation is one row, piece 0. One of more than HOT_ROWS rows and 1/4096 of all is dealt to
    several tasks by turn, and one of more than PIECE_BYTES leaves a task in pieces: such rows are
    not ``whole``, and their texts follow each other in order of (block, piece).

    A null text or role counts as empty; a null conv_id is a conversation of its own. Repeated rows
    are turns each. Texts of any length are taken whole, a single one up to 2 GB. Other columns are
    ignored. An empty table gives no rows.
    """
    given = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    limit = max(HOT_ROWS, given.count() // HOT_KEYS)
    large = (
        given.groupBy("conv_id")
        .count()
        .filter(F.col("count") > limit)
        .select(F.col("conv_id").alias("large_id"), F.lit(True).alias("hot"))
    )
    is_large = F.col("conv_id").eqNullSafe(F.col("large_id"))
    marked = given.join(F.broadcast(large), is_large, "left").select(  # 4096 rows at most
        *given.columns, F.coalesce("hot", F.lit(False)).alias("hot")
    )
    return (
        marked.withColumn("dealt", F.when(F.col("hot"), F.coalesce("turn", F.lit(-(2**63)))))
        .repartitionByRange("conv_id", "dealt")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text", "hot")
        .mapInArrow(formatter(template), FORMATTED_SQL)
    )


READ = "conv_id long, block int, piece int, whole boolean, n_turns long, turns binary, loss binary, n_chars long"


def reader(template: Template):
    """Reads formatted texts back: their turns, and what is learnt, as digests or, of a piece, as bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["text"]
                spoken = [
                    f"{role}\n{template.unescaped(text[a:b])}\n".encode() for role, a, b in template.turns(text)
                ]
                learnt = "".join(template.unescaped(text[s["start"] : s["end"]]) for s in row["loss_spans"])
                turns, loss, n_loss = b"".join(spoken), learnt.encode(), len(learnt)
                if row["whole"]:
                    turns, loss = sha256(turns).digest(), n_loss.to_bytes(8, "little") + sha256(loss).digest()
                own = (row["conv_id"], row["block"], row["piece"], row["whole"], len(spoken), turns, loss, len(text))
                rows.append(own)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            names = [column.split()[0] for column in READ.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return read


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their pieces, which come in order; none is held beyond a hash."""
    names = [column.split()[0] for column in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    open_ = None  # conv_id, turns, hash of turns, learnt code points, hash of them, code points

    def closed() -> list[tuple]:
        if open_ is None:
            return []
        conv_id, n_turns, turns, n_loss, loss, n_chars = open_
        return [(conv_id, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars)]

    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns, loss = row["turns"], row["loss"]
            if row["whole"]:
                n_loss = int.from_bytes(loss[:8], "little")
                rows.append((row["conv_id"], row["n_turns"], turns.hex(), n_loss, loss[8:].hex(), row["n_chars"]))
                continue
            if open_ is None or open_[0] != row["conv_id"]:
                rows += closed()
                open_ = [row["conv_id"], 0, sha256(), 0, sha256(), 0]
            open_[1] += row["n_turns"]
            open_[2].update(turns)
            open_[3] += len(loss.decode())
            open_[4].update(loss)
            open_[5] += row["n_chars"]
        yield batch_of(rows)
    yield batch_of(closed())


def digests(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted conversations say, read back from their texts and loss spans, per conversation.

    Returns conv_id, n_turns, turns_sha256 (of each turn's role and text, a line feed after either),
    loss_chars, loss_sha256 (of all that counts in the loss) and formatted_chars. A hash goes through
    a conversation in order; whole ones are hashed where they are read, the pieces of larger ones
    come together in order and are hashed as they stream by.
    """
    return (
        conversations.mapInArrow(reader(template), READ)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "piece")
        .mapInArrow(join_pieces, DIGESTS)
    )
