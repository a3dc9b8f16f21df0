"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, in fresh columns; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int
) -> list[tuple[int, str]]:
    """A bounded sample of labelled training texts as (label, text), in a fixed order.

    At most ``per_class`` rows of either label are drawn, by the hash of their id, from those that
    are not held out; texts of more than ``max_chars`` characters are left out of the sample. The
    draw looks at the labels alone, so no document but the drawn ones leaves the scan. Of several
    labels of a document the largest counts.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").cast("int").alias("y"))
        .withColumn("rank", F.xxhash64("doc_id"))
    )
    drawn = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy("rank", "doc_id").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = (
        keyed_texts(docs)
        .join(F.broadcast(drawn), "doc_id")  # 2 * per_class rows at most
        .filter(F.length("text") <= max_chars)
        .groupBy("doc_id")
        .agg(F.first("rank").alias("rank"), F.first("y").alias("y"), F.max("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["rank"], r["doc_id"]))
    return [(r["y"], r["text"]) for r in rows]


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Pairs of lists, of the first two columns of each batch."""
    for batch in batches:
        yield batch.column(0).to_pylist(), batch.column(1).to_pylist()


def rows_batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(values, type=kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
