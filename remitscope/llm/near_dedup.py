"""Near duplicates by SetSketch registers, verified on full sets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope.llm.components import HOT_KEYS, components, with_value
from remitscope.llm.words import STEP, grams, mixed, word_hashes, words_of
from remitscope.storage import written

REGISTERS = 128
BAND = 4
BASE = 1.001
RATE = 20.0
MOST_VALUE = 2**16 - 1
CHUNK_BYTES = 4_000_000
SMALL_BUCKET = 16
TILE_WORDS = 100_000
TILE_ROWS = 400
SHARED_COLUMNS = 8192
PAIRS_AT_ONCE = 20_000
GROUP_WORDS = 500_000
HOT_ROWS = 64
HUB_WORDS = 200_000
MARGIN = 12.5  # of log-likelihood, five standard errors


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle by itself."""
    words = words_of(texts, lower=True)
    hashes = word_hashes(words)
    whole = {n: grams(hashes, n) for n in range(1, size + 1)}
    sets = []
    for first, last in zip(words.firsts.tolist(), words.lasts.tolist()):
        n = min(size, last - first)
        if n == 0:
            sets.append(hashes[:0])
            continue
        own = np.sort(whole[n][first : last - n + 1])
        new = np.ones(len(own), dtype=bool)
        new[1:] = own[1:] != own[:-1]
        sets.append(own[new] + np.uint64(n))  # a text of one word is no text of three
    return sets


def digest(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """A 64-bit hash of each set: the sum of hashes of its elements."""
    sums = [int(mixed(s ^ np.uint64(seed)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
    return np.array(sums, dtype=np.uint64).view(np.int64)


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of each set, exponentially spaced and truncated to 16 bits.

    An element deals m ascending values to all registers in an order of its own, as the order
    statistics of m exponential variables; a register keeps the least it gets. An element stops
    once its values exceed all registers, so a large set costs few steps for each element. The
    register holds 1 - log_b(least / a), cut to an integer from 0 to 65535, and that of a union
    of sets is the largest of theirs.
    """
    least = np.full(len(sets) * m, np.inf)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = mixed(element + np.uint64(STEP))
    place = (order & np.uint64(m - 1)).astype(np.int64)
    stride = ((order >> np.uint64(32)) | np.uint64(1)) & np.uint64(m - 1)  # odd, so it meets all
    stride = stride.astype(np.int64)
    value = np.zeros(len(element))
    for step in range(m):
        if not len(element):
            break
        drawn = mixed(element + np.uint64((step + 2) * STEP % 2**64)) >> np.uint64(11)
        value -= np.log((drawn + 1) * 2.0**-53) / (m - step)
        np.minimum.at(least, owner * m + place, value)
        most = least.reshape(-1, m).max(axis=1)
        on = value < most[owner]
        element, owner, value, stride = element[on], owner[on], value[on], stride[on]
        place = (place[on] + stride) & (m - 1)
    with np.errstate(divide="ignore"):
        spaced = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    spaced = np.where(np.isfinite(spaced), spaced, 0)
    return np.clip(spaced, 0, MOST_VALUE).astype("<u2").reshape(-1, m)


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about 4 MB of text each, one text at least."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)])
    at = 0
    while at < len(sizes):
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK_BYTES)))
        yield batch.slice(at, upto - at)
        at = upto


SKETCH = "doc_id long, key long, n_shingles long, high long, low long, registers binary"


def sketcher(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                sets = shingle_sets(part.column(2), size)
                lines = registers(sets)
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest(sets, 1)),
                    pa.array(digest(sets, 2)),
                    pa.array([line.tobytes() for line in lines], pa.binary()),
                ]
                names = [field.split()[0] for field in SKETCH.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return sketch


def matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in column)
    return np.frombuffer(joined, "<u2").reshape(-1, REGISTERS)


def buckets_of(cells: np.ndarray) -> np.ndarray:
    """The 64 bits of each band's registers, mixed with the band's number."""
    number = np.arange(cells.shape[1], dtype=np.uint64) * np.uint64(STEP)
    return mixed(mixed(cells) + number).view(np.int64)


def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket for each band of four registers."""
    for batch in batches:
        buckets = buckets_of(matrix(batch.column(1)).copy().view("<u8"))
        nodes = np.repeat(batch.column(0).to_numpy(), buckets.shape[1])
        columns = [pa.array(buckets.ravel()), pa.array(nodes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "node"])


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the registers of two sets of known sizes allow a similarity of ``least``.

    The likelihood of the numbers of registers that are greater, smaller and equal is compared at
    ``least`` and above with its maximum; a pair goes if the best is five standard errors off.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    share = n_a / (n_a + n_b)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        def chance(x):
            return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

        up, down = chance(share - (1 - share) * j), chance((1 - share) - share * j)
        tiny = 1e-9
        return (
            more * np.log(up + tiny)
            + less * np.log(down + tiny)
            + same * np.log(np.maximum(1 - up - down, 0) + tiny)
        )

    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    every = np.array([log_likelihood(top * x) for x in np.linspace(0, 1, 21)]).max(axis=0)
    near = np.array([log_likelihood(np.minimum(top, x)) for x in np.linspace(least, 1, 7)]).max(axis=0)
    return (top >= least) & (near >= every - MARGIN)


def least_equal(least: float) -> float:
    """Equal registers below which the likelihood of ``least`` need not be looked at: seven
    standard errors, where five decide."""
    return REGISTERS * least - 7 * (REGISTERS * least * (1 - least)) ** 0.5


def estimator(percent: int):
    """Of rows (a, b, n_a, n_b, registers of both) the pairs that may be similar enough."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
            fits = plausible(matrix(batch.column(4)), matrix(batch.column(5)), n_a, n_b, percent / 100)
            columns = [pa.array(x[fits], pa.int64()) for x in (a, b, n_b)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "weight"])

    return estimate


def is_linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether the full sets, sorted arrays, are similar enough."""
    if not len(one) or not len(two):
        return False
    at = np.minimum(np.searchsorted(one, two), len(one) - 1)
    both = int((one[at] == two).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all sets of one side with all of the other.

    Products of zero-one matrices over the shingles that occur on both sides, some at a time.
    """
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (one, two)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    total = np.zeros((len(one), len(two)))
    if not len(shared):
        return total
    found = []
    for values, owner in sides:
        place = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        known = shared[place] == values
        place, owner = place[known], owner[known]
        order = np.argsort(place, kind="stable")
        found.append((place[order], owner[order]))
    for at in range(0, len(shared), SHARED_COLUMNS):
        cells = []
        for (place, owner), n in zip(found, total.shape):
            first, last = np.searchsorted(place, [at, at + SHARED_COLUMNS])
            cell = np.zeros((n, SHARED_COLUMNS), dtype=np.float32)
            cell[owner[first:last], place[first:last] - at] = 1
            cells.append(cell)
        total += cells[0] @ cells[1].T
    return total


def tile_links(size: int, percent: int):
    """The links of a tile: its rows of side 0 against those of side 1, between roots.

    A pair is judged in the first bucket alone that it shares. What the likelihood lets through
    is compared in full here, so that only links leave the task, however many pairs it looks at.
    """

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        sides = [rows.filter(pc.equal(rows.column("side"), side)) for side in (0, 1)]
        (one, two) = ({n: t.column(n).to_numpy() for n in ("node", "root", "n")} for t in sides)
        lines = [matrix(t.column("registers")) for t in sides]
        buckets = [buckets_of(x.copy().view("<u8")) for x in lines]
        pairs = [np.zeros((2, 0), dtype=np.int64)]
        for i in range(len(one["node"])):
            same = (lines[1] == lines[0][i]).sum(axis=1)
            near = (same >= least_equal(percent / 100)) & (two["root"] != one["root"][i])
            other = np.flatnonzero(near)
            shared = buckets[1][other] == buckets[0][i]
            first = buckets[0][i][shared.argmax(axis=1)]
            other = other[shared.any(axis=1) & (first == key[0].as_py())]
            a = np.full(len(other), i)
            pairs.append(np.array([a, other]))
        a, b = np.concatenate(pairs, axis=1)
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), PAIRS_AT_ONCE):
            x, y = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
            keep[at : at + PAIRS_AT_ONCE] = plausible(
                lines[0][x], lines[1][y], one["n"][x], two["n"][y], percent / 100
            )
        a, b = a[keep], b[keep]
        linked = np.zeros(0, dtype=bool)
        if len(a):
            (rows_a, at_a), (rows_b, at_b) = (np.unique(x, return_inverse=True) for x in (a, b))
            sets = [
                shingle_sets(t.column("text").take(pa.array(own)).combine_chunks(), size)
                for t, own in zip(sides, (rows_a, rows_b))
            ]
            both = overlaps(*sets)[at_a, at_b]
            sizes = [np.array([len(s) for s in own]) for own in sets]
            union = sizes[0][at_a] + sizes[1][at_b] - both
            linked = (both > 0) & (100 * both >= percent * union)
        columns = [one["node"][a[linked]], two["node"][b[linked]]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

    return links


def verifier(size: int, percent: int):
    """The pairs of a group whose full sets are similar enough; ``of`` names the hub of a row."""

    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        sets = shingle_sets(rows.column("text").combine_chunks(), size)
        hubs = rows.column("of").to_pylist()
        keys = rows.column("key").to_pylist()
        is_hub = rows.column("hub").to_pylist()
        by_hub: dict[int, list[int]] = {}
        for i, hub in enumerate(hubs):
            if is_hub[i]:
                by_hub.setdefault(hub, []).append(i)
        linked = set()
        for i, hub in enumerate(hubs):
            if is_hub[i]:
                continue
            for h in by_hub[hub]:
                if is_linked(sets[h], sets[i], percent):
                    linked.add((hub, keys[i]))
        columns = list(zip(*sorted(linked))) if linked else [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

    return verify


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Search:
    """The steps of one search; ``texts`` has key and text of every document."""

    def __init__(self, texts: DataFrame, size: int, percent: int):
        self.texts, self.size, self.percent = texts, size, percent
        self.spark = texts.sparkSession

    def plausible_pairs(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return sets.select(
                F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
            )

        least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        return (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .filter(100 * least >= self.percent * most)
            .select("a", "b", "n_a", "n_b", "r_a", "r_b")
            .mapInArrow(estimator(self.percent), "a long, b long, weight long")
            .distinct()
        )

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Edges u, v: pairs whose full sets are similar enough.

        A hub with many partners is dealt to several groups; each holds the hub and a part of them.
        """
        pairs = written(pairs, "near-pairs")
        words = pairs.agg(F.sum("weight")).first()[0] or 0
        groups = max(partitions(self.spark), -(-2 * words // GROUP_WORDS))
        hubs = pairs.groupBy("a").agg(F.ceil(F.sum("weight") / HUB_WORDS).alias("salts"))
        salted = pairs.join(hubs, "a").select(
            F.col("a").alias("of"), F.col("b").alias("key"), F.pmod(F.xxhash64("b"), "salts").alias("salt")
        )
        needed = (
            salted.select("key", "of", "salt", F.lit(False).alias("hub"))
            .unionByName(
                salted.select(F.col("of").alias("key"), "of", "salt").distinct().withColumn("hub", F.lit(True))
            )
            .withColumn("group", F.pmod(F.xxhash64("of", "salt"), F.lit(groups)))
            .drop("salt")
            .distinct()
        )
        return (
            self.texts.join(needed, "key")
            .select("group", "of", "key", "hub", "text")
            .groupBy("group")
            .applyInArrow(verifier(self.size, self.percent), "u long, v long")
        )

    def star_pairs(self, members: DataFrame) -> DataFrame:
        """Each node of a bucket with the least and the greatest of it."""
        ends = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        hub = F.explode(F.array("lo", "hi")).alias("a")
        return (
            members.join(ends, "bucket")
            .select(hub, F.col("node").alias("b"))
            .filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )

    def rest_links(self, members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
        """The links within each bucket between nodes that are not yet in one component.

        Small buckets are joined with themselves. In a larger one, nodes outside of its largest
        component meet all others in tiles of about 100,000 shingles, and 400 rows, on either side.
        """
        held = members.join(roots.withColumnRenamed("root", "found"), "node", "left").select(
            "bucket", "node", F.coalesce("found", "node").alias("root")
        )
        weight = F.greatest("n", F.lit(TILE_WORDS // TILE_ROWS))
        by_root = (
            held.join(sets.select("node", "n"), "node")
            .groupBy("bucket", "root")
            .agg(F.count(F.lit(1)).alias("count"), F.sum(weight).alias("words"))
        )
        open_buckets = written(
            by_root.groupBy("bucket")
            .agg(
                F.count(F.lit(1)).alias("roots"),
                F.sum("count").alias("rows"),
                F.sum("words").alias("words"),
                F.max(F.struct("words", "root")).alias("main"),
            )
            .filter("roots > 1")
            .select(
                "bucket",
                "rows",
                F.col("main.root").alias("main"),
                F.ceil(F.col("words") / TILE_WORDS).alias("blocks"),
                F.ceil((F.col("words") - F.col("main.words")) / TILE_WORDS).alias("out_blocks"),
            ),
            "near-buckets",
        )
        left = written(held.join(open_buckets, "bucket"), "near-members")
        small = left.filter(F.col("rows") <= SMALL_BUCKET).select("bucket", "node", "root")
        other = small.select("bucket", F.col("node").alias("b"), F.col("root").alias("other"))
        pairs = (
            small.withColumnRenamed("node", "a")
            .join(other, "bucket")
            .filter("a < b AND root <> other")
            .select("a", "b")
            .distinct()
        )
        large = (
            left.filter(F.col("rows") > SMALL_BUCKET)
            .join(sets, "node")
            .join(self.texts.withColumnRenamed("key", "node"), "node")
        )
        columns = ["bucket", "node", "root", "n", "registers", "text"]
        start = F.lit(0).cast("long")
        ones = large.filter("root <> main").select(
            *columns,
            F.lit(0).alias("side"),
            F.pmod(F.xxhash64("node"), "out_blocks").alias("i"),
            F.explode(F.sequence(start, F.col("blocks") - 1)).alias("j"),
        )
        twos = large.select(
            *columns,
            F.lit(1).alias("side"),
            F.explode(F.sequence(start, F.col("out_blocks") - 1)).alias("i"),
            F.pmod(F.xxhash64("node"), "blocks").alias("j"),
        )
        tiles = (
            ones.unionByName(twos)
            .groupBy("bucket", "i", "j")
            .applyInArrow(tile_links(self.size, self.percent), "u long, v long")
        )
        return self.verified(self.plausible_pairs(pairs, sets)).unionByName(tiles)


def with_key(docs: DataFrame) -> DataFrame:
    """doc_id, key and text; the key is the id, or for a null id a hash of the text."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return given.select("doc_id", node_key(F.col("doc_id"), F.col("text")).alias("key"), "text")


def node_key(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.xxhash64(F.coalesce(text, F.lit(""))))


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by shingle sets with a Jaccard similarity of ``percent`` or more.

    A document's set holds its distinct shingles of ``size`` consecutive words (split at ASCII
    white space, A-Z in lower case); a shorter text is one shingle. Returns doc_id, n_shingles,
    component_id (the least id that links lead to) and kept (doc_id = component_id), one row per
    input row.

    Each set becomes a SetSketch of 128 registers of 16 bits. Equal sets are one node. Nodes that
    agree in one of 32 bands of four registers share a bucket, which a pair with a similarity of 0.85
    misses with a chance below 1e-10, one of 0.8 below 1e-7. First each node meets the least and
    the greatest node of its buckets; what is then still apart within a bucket meets in pairs or
    tiles. A pair's similarity is judged by the joint likelihood of its registers, and what may
    reach the threshold is verified on the full sets.

    Null and empty texts have no set: 0 shingles, and a component of their own. Rows that share an
    id are one node, and all of them are kept if it is the least. Null ids are nodes by their
    text; they count as larger than any id, and where a component has no other, one text is kept.
    Other columns are ignored. An empty table gives no rows.
    """
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    return keyed_groups(docs, size, percent).select(*columns)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_groups`` keeps."""
    dropped = keyed_groups(docs, size, percent).filter("NOT kept").select("key").distinct()
    key = node_key(F.col("doc_id"), F.col("text"))
    return docs.join(dropped, key == dropped["key"], "left_anti")


def keyed_groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    given = with_key(docs)
    rows = written(given.mapInArrow(sketcher(size), SKETCH), "near-sketches")
    sets = written(
        rows.filter("n_shingles > 0")
        .groupBy("high", "low")
        .agg(
            F.min("key").alias("node"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("registers").alias("registers"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "near-sets",
    )
    banded = sets.select("node", "registers").mapInArrow(bands, "bucket long, node long")
    shared = banded.groupBy("bucket").count().filter("count > 1").select("bucket")
    members = written(banded.join(shared, "bucket").distinct(), "near-members")
    texts = written(
        given.select("key", "text").join(members.select(F.col("node").alias("key")).distinct(), "key"),
        "near-texts",
    )
    search = Search(texts, size, percent)
    sets = sets.select("node", "n", "registers", "high", "low", "copies")
    lines = sets.select("node", "n", "registers")
    equal = (
        rows.select("key", "high", "low", "n_shingles")
        .filter("n_shingles > 0")
        .join(sets.filter("copies > 1").select("high", "low", "node"), ["high", "low"])
        .select(F.col("key").alias("u"), F.col("node").alias("v"))
    )
    close = search.verified(search.plausible_pairs(search.star_pairs(members), lines))
    roots = components(equal.unionByName(close))
    more = written(search.rest_links(members, roots, lines), "near-edges")
    if not more.isEmpty():
        roots = components(
            roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)
        )
    placed = (
        rows.select("doc_id", "key", "n_shingles")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.when(F.col("n_shingles") > 0, F.coalesce("root", "key")))
    )
    least = (
        placed.filter("root IS NOT NULL")
        .groupBy("root")
        .agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    )
    most = max(HOT_ROWS, rows.count() // HOT_KEYS)
    return with_value(placed, "root", least, "least_id", most).select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") == 0, F.lit(True))
        .when(F.col("least_id").isNull(), F.col("key") == F.col("root"))
        .otherwise(F.coalesce(F.col("doc_id") == F.col("least_id"), F.lit(False)))
        .alias("kept"),
    )
