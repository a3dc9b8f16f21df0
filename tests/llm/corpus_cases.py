"""Tables with the awkward rows that every corpus operator must take, and plain helpers."""

import random
import re
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Names that the operators use inside; as columns of an input they must do no harm.
CLASHING = "unit key shard kind body rest hash piece pieces start row node bucket root score hub of group n"


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "ba ce di fo gu ha ki lo mé nu".split() for b in range(vocabulary // 10)]
    return " ".join(draw.choice(words) for _ in range(n))


def rows_of_documents():
    base = prose(1, 60)
    near = base.replace(base.split()[30], "other", 1)
    twice = f"{prose(2, 25)} {prose(3, 40)} {prose(2, 25)}"
    long = prose(4, 60_000)
    return [
        (0, None),
        (1, ""),
        (2, " \t\n "),
        (3, "One"),
        (4, "one two"),
        (5, base),
        (6, base),
        (7, near),
        (8, twice),
        (9, f"{prose(2, 25)}\n\ttail é ß ▁ 漢字   \U0001f600"),
        (10, long),
        (11, long[:-5] + "changed"),
        (12, "x" * 100_000),
        (13, base.upper()),
        (14, "Creative CC BY and all rights reserved. General  PUBLIC license; all rights reserved"),
        (15, " ".join(["same"] * 90)),
        (5, base),
        (None, base),
        (None, None),
        (-3, f"{prose(5, 30)} end"),
        (16, f"{prose(5, 30)} {prose(6, 30)}"),
    ]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {name: F.lit(f"{name} of the input") for name in CLASHING.split()}
    return made.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text"), **extra})


def digest(text):
    return sha256(text.encode()).hexdigest()


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def sorted_rows(rows):
    return sorted(rows, key=lambda row: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in row))
