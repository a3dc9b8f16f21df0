from collections import defaultdict

from pyspark.sql import functions as F

from corpus_cases import digest, frame, sorted_rows
from remitscope.llm import exact_dedup


def expected(rows, pick=max):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        given = False
        for doc_id in ids:
            kept = doc_id == keep and not given
            given = given or kept
            out.append((doc_id, keep, len(ids), kept, digest(text)))
    return sorted_rows(out)


def test_awkward_rows(messy, messy_rows):
    found = exact_dedup.exact_groups(messy).collect()
    assert sorted_rows(map(tuple, found)) == expected(messy_rows)
    found = exact_dedup.exact_groups(messy, keep="smallest").collect()
    assert sorted_rows(map(tuple, found)) == expected(messy_rows, min)


def test_no_rows(no_documents):
    assert exact_dedup.exact_groups(no_documents).count() == 0
    assert exact_dedup.distinct_documents(no_documents).count() == 0


def test_hot_text_in_pieces(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i // 2}") for i in range(3000)]
    found = exact_dedup.exact_groups(frame(spark, rows)).collect()
    assert sorted_rows(map(tuple, found)) == expected(rows)
    kept = exact_dedup.distinct_documents(frame(spark, rows).repartition(5))
    assert {row.doc_id for row in kept.select("doc_id").collect()} == {
        row[0] for row in expected(rows) if row[3]
    }


def test_documents_keep_their_columns(messy, messy_rows):
    kept = exact_dedup.distinct_documents(messy)
    assert kept.dtypes == messy.dtypes
    rows = [(row.doc_id, row.text) for row in kept.collect()]
    assert len(rows) == len({text or "" for _, text in messy_rows})
    best = {digest(text or ""): doc_id for doc_id, text in rows}
    assert best == {row[4]: row[1] for row in expected(messy_rows)}
    assert kept.filter(F.col("unit") != "unit of the input").count() == 0
