import corpus_pipeline
import pytest
from test_exact_dedup import expected as equal_groups
from test_near_dedup import expected as near_groups
from test_packing import check, tokenizer  # noqa: F401
from test_substring_dedup import expected as without_passages

from corpus_cases import frame, rows_of_documents
from remitscope.llm import quality
from remitscope.llm.common import table

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after each stage, with some awkward rows among them."""
    docs = table(spark, SF_DIR, "documents")
    more = [(i and 10_000 + i, text) for i, text in rows_of_documents() if text is None or len(text) < 50_000]
    docs = docs.unionByName(frame(spark, more).select(COLUMNS))
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def pairs(docs):
    return [(row.doc_id, row.text) for row in docs.collect()]


def ids(rows):
    return sorted((x for x in rows), key=lambda i: (i is not None, i or 0))


def test_all_but_the_last_stage_return_documents(steps):
    assert [docs.columns for docs in steps[:-1]] == [COLUMNS] * 5


def test_rejected_documents_go(spark, steps):
    model = quality.train(steps[0], table(spark, SF_DIR, "labels"))
    rows = quality.quality_scores(steps[0], model).filter("predicted = 1").collect()
    assert ids(i for i, _ in pairs(steps[1])) == ids(row.doc_id for row in rows)


def test_equal_texts_go(steps):
    wanted = [row[0] for row in equal_groups(pairs(steps[1])) if row[3]]
    assert ids(i for i, _ in pairs(steps[2])) == ids(wanted)


def test_one_of_each_near_group_stays(steps):
    wanted = [row[0] for row in near_groups(pairs(steps[2]), 5, 80) if row[3]]
    assert ids(i for i, _ in pairs(steps[3])) == ids(wanted)


def test_repeated_passages_go(steps):
    wanted = [(row[0], row[3]) for row in without_passages(pairs(steps[3]))]
    assert sorted(pairs(steps[4]), key=str) == sorted(wanted, key=str)
    assert all(row.n_chars == len(row.text) for row in steps[4].collect())


def test_every_token_is_packed(steps, tokenizer):  # noqa: F811
    check(pairs(steps[4]), steps[5].collect(), tokenizer)


def test_run_gives_the_last_stage(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == steps[5].columns and found.count() > 0


def test_no_documents(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
