"""Exact duplicates by a distributed sort of the contents."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from remitscope.llm.common import keyed_texts

HOT_KEYS = 4096
HOT_ROWS = 64
HOT_BYTES = 1_000_000
KEY_CHARS = 16


def run() -> WindowSpec:
    """Neighbours of the sort with equal contents."""
    return Window.partitionBy("start", "hash", "piece", "text")


def sorted_rows(rows: DataFrame) -> DataFrame:
    """The rows dealt to ranges of contents, the copies of a hot text in several pieces.

    Hot is a text whose copies are more than 1/4096 of all rows, or of all bytes; there are at most
    twice 4096 such texts, and a piece is no larger than that share unless it is a single row.
    """
    size = F.octet_length("text").cast("long")
    n, n_bytes = rows.agg(F.count(F.lit(1)), F.sum(size)).first()
    limit = max(HOT_ROWS, math.ceil(n / HOT_KEYS))
    most_bytes = max(HOT_BYTES, math.ceil((n_bytes or 0) / HOT_KEYS))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    pieces = F.greatest(F.ceil(F.col("n") / limit), F.ceil(F.col("bytes") / most_bytes))
    hot = (
        hashed.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
        .filter((F.col("n") > 1) & ((F.col("n") > limit) | (F.col("bytes") > most_bytes)))
        .select("hash", pieces.alias("pieces"))
    )
    return (
        hashed.join(F.broadcast(hot), "hash", "left")
        .withColumn(
            "piece",
            F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64("doc_id"), F.col("pieces"))
            ),
        )
        .withColumn("start", F.substring("text", 1, KEY_CHARS))
        .repartitionByRange("start", "hash", "piece")
    )


def exact_groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """Groups of documents with the same bytes of text, and the row of each that stays.

    Sampled splitters deal the texts to ranges, each range is sorted externally, and a window
    compares every text with its neighbour in full. The splitters are of the first 16 characters
    and a hash, so that what is sampled stays small however long the texts are. A text whose copies
    are more than 1/4096 of all rows (and more than 64) or bytes (and more than a megabyte) has them
    cut into pieces by id before the sort, so one text cannot fill a range; the pieces of these texts,
    some thousands in all, are found by the sort and joined up by digest afterwards.

    ``keep`` is "largest" or "smallest" id. Returns doc_id, keep_id, group_size, kept and
    text_sha256, one row for each input row.

    A null text counts as empty, and empty texts are equal. A null id is kept only where all ids of
    the group are null. Of repeated rows with the same id and text, one is kept. Other columns are
    ignored. An empty table gives no rows.
    """
    best, order = (F.max, F.desc_nulls_last) if keep == "largest" else (F.min, F.asc_nulls_last)
    runs = sorted_rows(keyed_texts(docs)).select(
        "doc_id",
        F.col("pieces").isNotNull().alias("hot"),
        F.sha2("text", 256).alias("text_sha256"),
        best("doc_id").over(run()).alias("run_id"),
        F.count(F.lit(1)).over(run()).alias("run_size"),
        F.row_number().over(run().orderBy(order("doc_id"))).alias("place"),
    )
    whole = (
        runs.filter("hot AND place = 1")
        .groupBy("text_sha256")
        .agg(best("run_id").alias("all_id"), F.sum("run_size").alias("all_size"))
    )
    joined = runs.join(F.broadcast(whole), "text_sha256", "left")
    is_hot = F.col("hot")
    keep_id = F.when(is_hot, F.col("all_id")).otherwise(F.col("run_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.when(is_hot, F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row of each group of equal texts, with all its columns; a null text stays null.

    The same content sort as in ``exact_groups``. The first row of each run stays; of a hot text
    the first rows of its pieces, some thousands in all, meet once more.
    """
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("text").isNull().alias("no_text"),
        (F.struct(*others) if others else F.lit(None).cast("int")).alias("rest"),
    )
    order = F.desc_nulls_last if keep == "largest" else F.asc_nulls_last
    heads = (
        sorted_rows(rows)
        .select(
            *rows.columns,
            F.col("pieces").isNotNull().alias("hot"),
            F.sha2("text", 256).alias("text_sha256"),
            F.row_number().over(run().orderBy(order("doc_id"))).alias("place"),
        )
        .filter("place = 1")
    )
    best = Window.partitionBy("text_sha256").orderBy(order("doc_id"))
    joined = heads.filter("hot").withColumn("place", F.row_number().over(best)).filter("place = 1")
    own = {"doc_id": F.col("doc_id"), "text": F.when(~F.col("no_text"), F.col("text")).alias("text")}
    columns = [own.get(name, F.col(f"rest.`{name}`")) for name in docs.columns]
    return heads.filter("NOT hot").select(columns).unionByName(joined.select(columns))
