"""A corpus pipeline: good documents, without copies and repeated passages, packed for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope.llm import exact_dedup, near_dedup, packing, quality, substring_dedup
from remitscope.llm.common import table
from remitscope.storage import written

LEAST_QUALITY = 0.3
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go.

    The model is trained on a bounded labelled sample of the documents given. A null text counts as
    empty and is judged as such; repeated rows fare alike; no documents give none.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, LEAST_QUALITY)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    A null text equals an empty one, a null id is the smallest, and of repeated rows one stays.
    """
    return exact_dedup.distinct_documents(docs, keep="largest")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    Texts without words are near nothing and all stay; of repeated rows one stays.
    """
    return near_dedup.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that repeat go; the others are joined by one blank.

    A null text becomes an empty one; a document all of whose words go stays, empty. A null id is the
    largest; of repeated rows one keeps its words.
    """
    kept = substring_dedup.without_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    carried = {"doc_id", "text", "n_chars"}
    return kept.select(*[name if name in carried else F.col(f"rest.`{name}`") for name in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048, a row for each piece.

    A null or empty text is its end mark alone; repeated rows are packed each; no documents, no rows.
    """
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("substring dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

# SQL can express neither the classifier nor the tokenizer; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
