import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import LOWER, prose, sorted_rows
from remitscope.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def expected(rows, least, smoothing=5, scale=10**9, most=50):
    """By plain loops over Python integers."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        held[lang].update(terms.keys())
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        of_lang = Counter()
        for source in sources:
            of_lang.update(counts[lang, source])

        def shares(n, kept=kept):
            whole = sum(n[t] for t in kept) + smoothing * len(kept)
            return {t: 1 + scale * (n[t] + smoothing) // whole for t in kept}

        whole = shares(of_lang)
        own = {source: shares(counts[lang, source]) for source in sources}
        for source in sources:
            pairs = [(o, sum(abs(own[source][t] - own[o][t]) for t in kept)) for o in sources - {source}]
            terms = [(t, own[source][t] - whole[t]) for t in kept if counts[lang, source][t]]
            terms = [(t, v) for t, v in terms if v > 0]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(found[:limit])]
    return sorted_rows(out)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {n: F.lit("x") for n in ("shard", "term", "n", "digest", "copies", "item", "value", "part", "rank")}
    )
    return sorted_rows(map(tuple, divergence.audit(docs.repartition(5), **more).collect()))


@pytest.fixture
def rows():
    given = [
        (i, prose(i % 40, 5 + i % 23, 60), ("en", "de", "fr")[i % 3], f"s{i % 7 if i % 5 else 0}") for i in range(300)
    ]
    return given + [
        (1, None, "en", "s1"),
        (2, "", "en", "only empty"),
        (3, "Ünder_score É É 漢字 x1y don't \U0001f600 A-Z", "en", None),
        (4, "same text", None, "s1"),
        (5, "same text", None, "s2"),
        (None, "Same TEXT same", "", None),
        (6, "rare words here", "xx", "a"),
        (7, None, "xx", "b"),
        (8, prose(3, 20), "yy", "alone"),
        (8, prose(3, 20), "yy", "alone"),
        (9, "\x00\x01 12345 !?", "zz", "a"),
    ]


@pytest.mark.parametrize("least", [1, 2, 8])
def test_awkward_rows(spark, rows, least):
    assert found(spark, rows, least_documents=least) == expected(rows, least)


def test_ties_fall_to_the_smaller_item(spark):
    rows = [(i, "é z a bb aa", "en", f"s{i % 4}") for i in range(8)] + [(9, "z é bb aa a b", "en", "s9")]
    got = found(spark, rows, least_documents=1, most_terms=3)
    assert got == expected(rows, 1, most=3)


def test_many_units_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_BYTES", 2_000)
    rows = rows + [(1000 + i, prose(7, 40), "en", f"s{i % 11}") for i in range(400)]
    assert found(spark, rows, least_documents=5) == expected(rows, 5)


def test_a_unit_that_is_full_leaves(rows):
    def batches():
        import pyarrow as pa

        copies = pa.array([[{"source": s or "", "n": 1}] for _, _, _, s in rows])
        given = [pa.array([lang or "" for _, _, lang, _ in rows]), pa.array([t or "" for _, t, _, _ in rows]), copies]
        yield pa.RecordBatch.from_arrays(given, names=["lang", "text", "copies"])

    full = divergence.UNIT_WORDS
    try:
        divergence.UNIT_WORDS = 200
        units = [row for batch in divergence.counter(3)(batches()) for row in batch.to_pylist()]
    finally:
        divergence.UNIT_WORDS = full
    assert len(units) > 20
    assert {row["shard"] for row in units} == {0, 1, 2}
    documents = sum(divergence.unpack(row["documents"]).sum() for row in units)
    assert documents == sum(len(set(TERM.findall((t or "").translate(LOWER)))) for _, t, _, _ in rows)


def test_slices_cut_no_term(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 50)
    text = prose(11, 400).encode() + b"x" * 300 + " é漢 end".encode()
    parts = list(divergence.slices(text))
    assert b"".join(parts) == text and len(parts) > 5
    assert [t for p in parts for t in divergence.TERM.findall(p)] == divergence.TERM.findall(text)


def test_a_very_long_text_counts_once_as_document(spark, monkeypatch):
    rows = [(0, prose(1, 60_000), "en", "a"), (1, prose(2, 200), "en", "b")]
    assert found(spark, rows, least_documents=2) == expected(rows, 2)


def test_shares_are_exact_where_a_product_would_overflow():
    n = np.array([0, 1, 10**13, 2 * 10**14], np.int64)
    whole = np.int64(2 * 10**14 + 10**13)
    wanted = [1 + 10**9 * (int(x) + 5) // int(whole) for x in n]
    assert divergence.shares(n, whole, 5, 10**9).tolist() == wanted


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(docs).count() == 0
    with pytest.raises(ValueError, match="scale"):
        divergence.audit(docs, scale=7)
