import public_tokenizers
import pytest
import sentencepiece

from corpus_cases import digest, sorted_rows
from remitscope.llm import sentence_pieces


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentence_pieces.MODEL))


def expected(pieces, rows):
    out = []
    for doc_id, text in rows:
        ids = pieces.encode(text or "")
        out.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(pieces.decode(ids))))
    return sorted_rows(out)


def test_awkward_rows_in_units_of_any_size(messy, messy_rows, pieces):
    wanted = expected(pieces, messy_rows)
    for unit_chars, shard_rows in ((sentence_pieces.UNIT_CHARS, sentence_pieces.SHARD_ROWS), (200, 2)):
        found = sentence_pieces.piece_digests(messy, unit_chars=unit_chars, shard_rows=shard_rows)
        assert sorted_rows(map(tuple, found.collect())) == wanted


def test_marks_line_feeds_and_odd_blanks(spark, pieces):
    texts = ["▁a ▁ b", "\n", " \n x", "a\n\n b ", "a　b c", "\t\x00\x01", "ﬁ ① é", "▁▁", "a  ▁ b\r\n"]
    rows = list(enumerate(texts))
    found = sentence_pieces.piece_digests(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted_rows(map(tuple, found.collect())) == expected(pieces, rows)


def test_words_may_be_forgotten(messy, messy_rows, pieces, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MOST_WORDS", 3)
    found = sentence_pieces.piece_digests(messy, unit_chars=500, shard_rows=5)
    assert sorted_rows(map(tuple, found.collect())) == expected(pieces, messy_rows)


def test_no_rows(no_documents):
    assert sentence_pieces.piece_digests(no_documents).count() == 0
