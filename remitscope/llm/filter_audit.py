"""How text filters overlap: what each removes in every order, and its Shapley value by potentials."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The filters in order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#$%&*|]"

ALL = (1 << len(FILTERS)) - 1
ORDERS = factorial(len(FILTERS))


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, a digest of the text and the bits of those filters, of A to D, that it fails."""
    text = F.col("text")
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.coalesce(text, F.lit("")).alias("text"),
    ).withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    n_words = F.size("words")
    fails = {
        "A": n_words < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT_PERCENT * n_words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS_PERCENT * F.char_length(text),
        "D": text.rlike(SYMBOL),
    }
    mask = sum((F.when(test, bit(letter)).otherwise(0) for letter, test in fails.items()), F.lit(0))
    return measured.select("doc_id", "part", F.unhex(F.sha2(text, 256)).alias("digest"), mask.alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, repeated ones as one with their number, and whether labels call them good or toxic."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), "quality", "toxic")
        .filter("label_id IS NOT NULL")
        .groupBy("label_id")
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    # Rows without an id match no label; a hash of their text spreads them.
    key = F.coalesce(F.col("doc_id"), F.xxhash64("digest"))
    return (
        rows.groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known, (key == F.col("label_id")) & F.col("doc_id").isNotNull(), "left")
        .select(
            *["doc_id", "part", "digest", "mask", "n"],
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail exactly the filters of a mask.

    Copies of a text fail the same filters but E, which all of them fail except the rows with the
    text's smallest id. So a text's rows are counted by part and labels first, with map-side
    combining; what meets in one group per text is a few rows for each part that has it.
    """
    same = Window.partitionBy("digest")
    has_id = F.col("doc_id").isNotNull()
    counted = (
        with_labels(text_failures(docs), labels)
        .groupBy("digest", "mask", "part", "good", "toxic")
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(has_id, F.col("n"))), F.lit(0)).alias("with_id"),
            F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("least"),
        )
        .withColumn("first_id", F.min("least.doc_id").over(same))
    )
    at_first = F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    copies = F.col("with_id") - at_first
    outcomes = F.array(
        F.struct((F.col("mask") + bit("E")).alias("mask"), copies.alias("n")),
        F.struct("mask", (F.col("n") - copies).alias("n")),
    )
    return (
        counted.select("part", "good", "toxic", F.inline(outcomes))
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def removed_by(measure: str) -> Column:
    """For each coalition of filters, by its mask, what it removes: the rows failing any of them."""

    def total(coalition: Column) -> Column:
        return F.aggregate(
            "counts",
            F.lit(0).cast("long"),
            lambda sum_, row: sum_
            + F.when(row["mask"].bitwiseAND(coalition) != 0, row[measure]).otherwise(F.lit(0).cast("long")),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(ALL)), total)


def potentials() -> Column:
    """Hart and Mas-Colell's potential of each coalition in the game "removed", times all orders.

    The potential of a coalition is its worth, plus the potentials of the coalitions with one filter
    less, over its size. These have smaller masks, so one pass over the masks is the recursion.
    Every division is exact: a potential is a sum of integers over sizes up to five.
    """

    def extend(known: Column, coalition: Column) -> Column:
        smaller = F.lit(0).cast("long")
        for letter in FILTERS:
            without = F.get(known, coalition.bitwiseAND(F.lit(ALL - bit(letter))))
            holds = coalition.bitwiseAND(F.lit(bit(letter))) != 0
            smaller = smaller + F.when(holds, without).otherwise(F.lit(0).cast("long"))
        worth = F.get(F.col("removed_by"), coalition) * ORDERS
        size = F.bit_count(coalition).cast("long")
        return F.concat(known, F.array(F.call_function("div", worth + smaller, size)))

    nothing = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), nothing, extend)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes, in every part, at every step of every order of the filters.

    A document fails A with fewer than 50 words, B with less than 65 % distinct ones, C with more
    than 5 % capitals A-Z, D with any of ``#$%&*|``, and E if its text is that of a smaller doc_id
    anywhere in the table. Documents are counted by the set of filters that they fail; of these
    counts, 32 at most per part, everything is worked out: a coalition of filters removes what fails
    any of them, steps are differences of coalitions, and a Shapley value is the potential of all
    filters less that of all others.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley, 600 rows for each value of ``source``.

    A null text counts as empty, a null source as ''. A row without doc_id is no copy, makes none,
    and has no label; of labels that repeat a document any 1 counts. Repeated rows count each, and
    share their E: rows of the smallest id of a text all pass it. An empty text fails A alone, and E
    as any text does. Very long texts are taken whole. Other columns are ignored. An empty table
    gives no rows.
    """
    by_part = (
        failure_counts(docs, labels)
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"), F.sum("n").alias("total"))
        .select(
            "part",
            "total",
            removed_by("n").alias("removed_by"),
            removed_by("good").alias("good_by"),
            removed_by("toxic").alias("toxic_by"),
        )
        .withColumn("potential", potentials())
    )
    orders = ",".join("".join(letters) for letters in permutations(FILTERS))
    place = F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    earlier = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(FILTERS))),
        F.lit(0),
        lambda mask, i: mask
        + F.when(
            i < F.col("step"),
            F.call_function(
                "shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring("filter_order", i, F.lit(1))) - 1
            ),
        ).otherwise(0),
    )
    steps = (
        by_part.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumns({"own": F.call_function("shiftleft", F.lit(1), place), "before": earlier})
        .withColumn("after", F.col("before") + F.col("own"))
    )

    def at(array: str, mask: Column | str) -> Column:
        return F.get(array, F.col(mask) if isinstance(mask, str) else mask)

    others = F.lit(ALL) - F.col("own")
    removed = at("removed_by", "after") - at("removed_by", "before")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at("removed_by", "after")).alias("kept"),
        removed.alias("removed"),
        (at("removed_by", "own") - removed).alias("redundant"),
        (at("removed_by", F.lit(ALL)) - at("removed_by", others)).alias("unique_fails"),
        (at("good_by", "after") - at("good_by", "before")).alias("good_lost"),
        (at("toxic_by", "after") - at("toxic_by", "before")).alias("toxic_lost"),
        (at("potential", F.lit(ALL)) - at("potential", others)).alias("shapley"),
    )
