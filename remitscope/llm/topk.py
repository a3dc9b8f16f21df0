"""Exact top-k search by inner product, in tiles of a query block and a block of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE_ROWS = 4096
QUERY_ROWS = 256
SHARD_ROWS = 8192
EXACT = 2.0**53


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vector.isNotNull() & finite


def packer(limit: int):
    """Turns rows (id, vector) into rows that hold up to ``limit`` of them as one matrix."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            flat = np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
            out = []
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                for at in range(0, len(rows), limit):
                    some = rows[at : at + limit]
                    matrix = flat[starts[some][:, None] + np.arange(dim)]
                    small = np.abs(matrix).max(initial=0) < 2**15
                    kind = np.int16 if small else np.float64
                    out.append(
                        {
                            "dim": int(dim),
                            "n": len(some),
                            "mark": int(ids[some[0]]),
                            "ids": ids[some].astype(np.int64).tobytes(),
                            "narrow": bool(small),
                            "matrix": matrix.astype(kind).tobytes(),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=PACKED_ARROW)

    return pack


PACKED = "dim int, n int, mark long, ids binary, narrow boolean, matrix binary"
PACKED_ARROW = pa.schema(
    [
        ("dim", pa.int32()),
        ("n", pa.int32()),
        ("mark", pa.int64()),
        ("ids", pa.binary()),
        ("narrow", pa.bool_()),
        ("matrix", pa.binary()),
    ]
)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products; those beyond 64 bits stop at the largest or smallest long."""
    if queries.shape[1] == 0:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    top = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if top < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    wide = whole(queries) @ whole(rows).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids; of equal scores the smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -(2**63) else -scores))
    return scores[order[:k]], ids[order[:k]]


def tile_search(k: int):
    """Multiplies the tiles of a task and merges their top lists, query by query."""

    def matrix(row: dict, side: str) -> np.ndarray:
        kind = np.int16 if row[f"{side}_narrow"] else np.float64
        shape = (row[f"{side}_n"], row["dim"])
        return np.frombuffer(row[f"{side}_matrix"], dtype=kind).reshape(shape).astype(float)

    def flush(tops: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], []]
        for query, (scores, ids) in tops.items():
            columns[0] += [query] * len(ids)
            columns[1] += ids.tolist()
            columns[2] += scores.tolist()
        names = ["query_id", "vec_id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                asked = np.frombuffer(row["q_ids"], dtype=np.int64)
                ids = np.frombuffer(row["c_ids"], dtype=np.int64)
                scores = products(matrix(row, "q"), matrix(row, "c"))
                for j, query in enumerate(asked.tolist()):
                    other = ids != query
                    found = best_of(scores[j][other], ids[other], k)
                    if query in tops:
                        found = best_of(*map(np.concatenate, zip(tops[query], found)), k)
                    tops[query] = found
                if len(tops) > 64 * QUERY_ROWS:
                    yield flush(tops)
                    tops = {}
        yield flush(tops)

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` other rows of the highest integer inner product, for each query row.

    ``vectors`` has vec_id and embedding; components are turned into floor(256 * x). Candidates are
    packed where they are read, into matrices of up to 4096 rows; blocks of 256 queries meet each
    shard of about 8192 candidates. A task multiplies its tiles, selects each tile's best, and
    merges them; the lists of the tasks are merged by a window with a group limit before its
    exchange, so a query's list never grows beyond k rows per task.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part. Only vectors of the same length are compared; empty ones score 0. A query whose id occurs
    several times is asked once, with its smallest vector, and skips all rows of its id; repeated
    candidate rows each count. Ties go to the smaller id. Scores beyond 64 bits stop at its ends.
    Other columns are ignored. An empty table, or a query without candidates, gives no rows.
    """
    valid = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").alias("vector"),
        is_query.alias("asked"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    n = vectors.count()
    shards = max(1, -(-n // SHARD_ROWS))
    rows = valid.select("vec_id", "vector").mapInArrow(packer(TILE_ROWS), PACKED)
    candidates = rows.select(
        "dim",
        F.pmod(F.xxhash64("mark", "ids"), F.lit(shards)).cast("int").alias("shard"),
        *[F.col(c).alias(f"c_{c}") for c in ("n", "ids", "narrow", "matrix")],
    )
    queries = (
        valid.filter("asked")
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .mapInArrow(packer(QUERY_ROWS), PACKED)
        .select(
            "dim",
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "narrow", "matrix")],
        )
    )
    found = candidates.join(queries, ["dim", "shard"]).mapInArrow(
        tile_search(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
