import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from corpus_cases import BLANKS, prose, sorted_rows
from remitscope.llm import filter_audit


def expected(rows, labels):
    """Every order applied to every document, one after the other."""
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, is_toxic in labels if i is not None and is_toxic == 1}
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    failing = []
    for doc_id, text, source in rows:
        text = text or ""
        words = BLANKS.findall(text)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and first[text] < doc_id:
            fails.add("E")
        failing.append((source or "", fails, doc_id in good, doc_id in toxic))
    out = []
    for part in {row[0] for row in failing}:
        own = [row for row in failing if row[0] == part]
        steps, removed_in_all = {}, Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[1]]
                left = [row for row in left if letter not in row[1]]
                n_failing = sum(letter in row[1] for row in own)
                only = sum(row[1] == {letter} for row in own)
                steps[order, step] = (
                    *(letter, len(left), len(gone), n_failing - len(gone), only),
                    *(sum(row[2] for row in gone), sum(row[3] for row in gone)),
                )
                removed_in_all[letter] += len(gone)
        for (order, step), (letter, *counts) in steps.items():
            out.append((part, "".join(order), step, *counts, removed_in_all[letter]))
    return sorted_rows(out)


def found(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {n: F.lit("x") for n in ("part", "mask", "n", "digest", "good", "toxic", "words", "step", "label_id", "quality")}
    )
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit("x"))
    return sorted_rows(map(tuple, filter_audit.audit(docs.repartition(5), known).collect()))


def awkward():
    base = prose(1, 60)
    rows = [(i, text, source) for i, text, source in [
        (0, None, None), (1, "", "a"), (2, " \t\n ", "a"), (3, "One", "a"), (4, "SHOUT", "b"),
        (5, base, "a"), (6, base, "b"), (5, base, "a"), (5, base, "b"), (-4, base, "c"), (None, base, "a"),
        (7, base.upper(), "a"), (8, base + " #", "a"), (9, "same " * 90, "a"), (10, "same " * 90, ""),
        (11, "A" * 5 + "é" * 95, "a"), (12, "A" * 6 + "é" * 94, "a"), (None, None, "only null"), (None, "", "a"),
        (13, " ".join(f"w{i % 65}" for i in range(100)), "a"), (14, " ".join(f"w{i % 64}" for i in range(100)), "a"),
        (15, " ".join(f"w{i}" for i in range(49)), "a"), (16, " ".join(f"w{i}" for i in range(60)), "a"),
        (17, prose(3, 40_000), "a"), (18, prose(3, 40_000), "a"), (19, "漢字 | \U0001f600", None),
    ]]
    labels = [(5, 1, 0), (5, 0, 1), (6, 1, None), (8, None, 1), (None, 1, 1), (1, 1, 1), (99, 1, 1), (18, 1, 1)]
    return rows, labels


def test_awkward_rows(spark):
    rows, labels = awkward()
    assert found(spark, rows, labels) == expected(rows, labels)


def test_a_hot_text_and_a_hot_source(spark):
    draw = [prose(i, 30 + i % 50) + (" #" if i % 7 == 0 else "") for i in range(40)]
    rows = [(i, "the hot text" if i % 3 else draw[i % 40], f"s{i % 5 if i % 2 else 0}") for i in range(1200)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 1200, 3)]
    assert found(spark, rows, labels) == expected(rows, labels)


def test_shapley_values_share_out_what_all_filters_remove(spark):
    rows, labels = awkward()
    for part in {source or "" for _, _, source in rows}:
        own = [r for r in found(spark, rows, labels) if r[0] == part and r[1] == "ABCDE"]
        assert sum(r[9] for r in own) == 120 * sum(r[4] for r in own)
        break


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    some = spark.createDataFrame([(1, "x", "s")], docs.schema)
    assert filter_audit.audit(some, labels).count() == 600
